"""Named operators, SQL over named tables, and the registered queries."""
