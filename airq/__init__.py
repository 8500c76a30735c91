"""airq: sensor-network analytics expressed as PySpark DataFrame operators."""
