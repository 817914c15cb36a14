"""DataFrame operators over observations."""
