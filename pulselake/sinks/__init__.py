"""Writers of archives, tables, measures and dead letters."""
