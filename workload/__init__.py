"""The library's queries over the star-schema test tables, with the SQL they must equal."""
