"""DataFrame-in, DataFrame-out operators.

Row order is data here: every relation carries an ordinal, and "first" or "last" is a
``min_by``/``max_by`` on it, which combines on the map side, so a hot key costs no more
than any other.
"""
