"""The two streaming queries, their sinks and the read model they keep."""
