"""DataFrame -> DataFrame operators. Stateful ones dispatch on ``df.isStreaming``."""
