"""yoyflow: year-over-year contract and renewal analytics on Spark DataFrames.

The package is organised as

* ``functions`` -- Column-level helpers (case-insensitive text tests, positional
  key decoding, ordered first-match rule tables).
* ``sources``   -- input schemas, fixed code tables and the adapters that map the
  driver's test tables onto job inputs.
* ``operators`` -- reusable DataFrame operators (lookups, year-offset joins,
  group flags, prior-value allocation, roll-forward, tiered best match,
  update-from, audits).
* ``plans``     -- the two end-to-end jobs composed from the operators and the
  registry of named queries.

Everything is expressed with native DataFrame expressions; there are no Python
UDFs on any data path.
"""

from yoyflow.params import RunParams

__all__ = ["RunParams"]
