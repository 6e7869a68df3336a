"""The registered queries, each with the SQL another engine must agree with."""
