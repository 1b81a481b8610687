"""Named queries over the test tables, each with its oracle SQL where SQL can express it."""
