"""The registered queries over the given tables, each with SQL for comparison where SQL can say it."""
