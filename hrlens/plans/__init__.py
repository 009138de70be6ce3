"""The analyses, one function per query key (see ``catalog``)."""
