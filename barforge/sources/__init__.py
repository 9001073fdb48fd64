"""Sources and sinks: CSV master lists, landing price files, the bronze
table, versioned layer storage, and the adapter that derives price
fixtures from the driver's TPC-H-style tables."""
