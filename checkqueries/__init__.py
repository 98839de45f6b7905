"""The registered queries over the driver's test tables, and their SQL: not part of the library."""
