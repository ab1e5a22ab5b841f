"""Writers: landed partitions, layer tables, reports."""
