"""Table-in / table-out operators.  None of them runs an action."""
