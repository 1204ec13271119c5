"""Small column-expression builders shared by the operators and reports."""
