"""Training-data pipeline operators.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when it can be imported. Every operator takes a DataFrame with the
columns it names and ignores all other columns, whatever they are called.
"""
