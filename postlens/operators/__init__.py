"""DataFrame-to-DataFrame operators.

Every summary takes ``by``: columns naming the community. With ``by=()`` the
whole input is one community and the result describes all of it.
"""
