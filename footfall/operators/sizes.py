"""The bound on what is broadcast."""

# All tables that one join broadcasts together, counted in bytes before they are sent.
BROADCAST_BYTES = 64 << 20
