"""ledgerflow: statement lines and transaction messages to a classified ledger, on Spark."""
__version__ = "0.1.0"
