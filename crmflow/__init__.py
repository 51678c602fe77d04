"""crmflow: customer analytics and table operators as plain PySpark DataFrame functions."""
