"""airway: Spark DataFrame operators and batch jobs for vehicle tracks,
on-board diagnostics and air-quality station feeds."""
