"""Sources: tables, JSON records, files with checksums, web pages and PDF text."""
