"""The layers as streaming queries."""
