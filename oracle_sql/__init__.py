"""Independent DuckDB SQL twins of the Spark queries (the correctness oracle).

The SQL follows the reference's model text (the literal, un-rewritten forms)
so that it checks the Spark plans' rewrites.  The shared numeric conventions
of the library are written out explicitly here:

* ``ratio``: a decimal ratio rounded half away from zero at 18 places, done in
  exact integer arithmetic (DuckDB's decimal division returns a double);
* averages are ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``;
* integer averages truncate (``//``).

Every query ends in an oracle-facing projection: integers → BIGINT,
decimals → DOUBLE, dates → 'YYYY-MM-DD' text, timestamps → text.
"""
