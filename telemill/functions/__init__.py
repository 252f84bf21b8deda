from .draws import Draws  # noqa: F401
