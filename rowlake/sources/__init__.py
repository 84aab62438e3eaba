"""Message logs, envelopes, lake tables and RDBMS catalogs."""
