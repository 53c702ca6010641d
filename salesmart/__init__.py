"""salesmart: a PySpark-native retail-sales analytics engine.

Layers (each a plain DataFrame function, no UDFs):

* ``sources``   – source specs, loading, freshness, and the test-data adapter
* ``functions`` – reusable Column expressions (text, dates, numbers, business rules)
* ``plans``     – the eight models (staging, intermediate, marts) and the build run
* ``operators`` – data-quality checks, publishing, incremental loads, history (SCD)
* ``streaming`` – the speed view and the batch+speed serving view
"""

from salesmart.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
