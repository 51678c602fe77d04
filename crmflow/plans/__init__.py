"""The three layers: conformed tables and the business tables built on them."""
