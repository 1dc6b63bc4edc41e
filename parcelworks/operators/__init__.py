"""DataFrame-to-DataFrame operators; each can be chained with ``df.transform``."""
