"""End-to-end plans: the micro-batch job body, the notebook path, serving."""
