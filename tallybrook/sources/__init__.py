"""Where rows come from: JSON lines, tables, JDBC, inline values, fixtures and adapters."""
