"""Reading and writing. Everything that touches storage is here."""
