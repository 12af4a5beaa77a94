"""Reading and writing: files, workbooks, JDBC, layer tables, staging."""
