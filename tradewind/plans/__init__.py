"""The models: staging, intermediate and mart tables, and the jobs that load and publish them."""
