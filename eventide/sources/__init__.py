from .tables import TABLES, load, load_all  # noqa: F401
