"""How the operators combine into layers and into the audit log."""
