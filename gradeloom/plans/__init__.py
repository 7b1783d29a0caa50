"""Plan-level helpers, and the registered queries with their SQL counterparts."""
