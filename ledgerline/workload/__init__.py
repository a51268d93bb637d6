"""The library's operators as queries over the driver tables, with reference SQL."""
