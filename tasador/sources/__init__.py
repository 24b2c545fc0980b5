"""Reading: catalog tables, dictionaries, listing pages.  Writing: staged tables and JDBC."""
