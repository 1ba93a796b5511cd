"""All registered queries."""


def registry():
    """The catalog with every query module loaded."""
    from stayline.catalog import base, client_grain, derived, exploring, learning, modelling, scored, tables  # noqa: F401

    return base
