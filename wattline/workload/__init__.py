"""The library's operators bound to the star-schema test tables, with SQL to check them."""
