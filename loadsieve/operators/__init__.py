"""DataFrame operators: cleaning, validation, header matching, mapping and reports."""
