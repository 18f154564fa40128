"""Sources: lake scans (SRC1), envelope readers (SRC2-5), serving-table
scans and lookups (SRC6-7), the location dimension (SRC8) and the fixture
feeds derived from the supplied tables."""
