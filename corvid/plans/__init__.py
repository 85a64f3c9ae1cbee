"""Named plans over the test tables: the query catalog and its oracle SQL."""
