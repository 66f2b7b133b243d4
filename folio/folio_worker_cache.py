"""Per-process cache of models, shipped to Python workers with ``addPyFile``
so that it is one module there (the package itself travels by value)."""

MODELS: dict = {}
