"""DataFrame operators: `DataFrame -> DataFrame`, without I/O or clock."""
