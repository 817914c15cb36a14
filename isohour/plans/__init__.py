"""Jobs that compose sources and operators, and the query catalogue."""
