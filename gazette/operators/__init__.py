"""DataFrame operators: each takes frames and returns frames, nothing runs until an action."""
