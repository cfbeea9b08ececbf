"""The weather models: silver, feature store, marts, reports, anomaly model."""
