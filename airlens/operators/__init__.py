"""DataFrame -> DataFrame operators, made for ``df.transform(...)``."""
