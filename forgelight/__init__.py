"""forgelight: source-repository analytics as PySpark DataFrame operators."""
