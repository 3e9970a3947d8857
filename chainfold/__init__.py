"""chainfold: account state from a ledger's block stream, written for Spark."""
