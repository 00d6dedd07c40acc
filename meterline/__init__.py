"""meterline — usage metering against quotas on Spark DataFrames (batch and Structured Streaming)."""

__version__ = "0.1.0"
