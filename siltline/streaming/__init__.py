"""Entity patches as a stream: current state, history, counts."""
