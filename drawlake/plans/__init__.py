"""Named query plans over the test tables, and the job that composes stages."""
