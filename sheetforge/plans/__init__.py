"""Plans over several tables: building, publishing and serving releases."""
