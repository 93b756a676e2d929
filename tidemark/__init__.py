"""Lending KPI analytics on Spark: versioned events in, restated daily marts out."""
