"""The business steps. Each maps tables to a table; ``refresh`` runs them in order."""
