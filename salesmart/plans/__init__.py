"""Model plans: staging, intermediate and mart models, and the build run."""
