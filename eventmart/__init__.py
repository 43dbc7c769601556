"""eventmart: behavioural-event lakehouse (raw -> canonical -> daily metrics) on Spark."""

__version__ = "0.1.0"
