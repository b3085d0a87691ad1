"""Message publishing (K8)."""
