"""The registered queries: every operator over the driver's tables, with its SQL twin."""
