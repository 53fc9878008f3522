"""The derived telemetry input and its SQL oracle, used by the driver contract and the tests."""
