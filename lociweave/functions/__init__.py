from . import bases, coords, rates, splice  # noqa: F401
