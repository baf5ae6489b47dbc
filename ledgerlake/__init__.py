"""Event-warehouse operators on PySpark: quarantine, flags, collisions, as-of costs, net facts."""
