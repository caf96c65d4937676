"""DataFrame-to-DataFrame operators; the same ones serve tables and streams."""
