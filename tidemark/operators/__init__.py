"""DataFrame-to-DataFrame operators.

None of them runs an action, but for ``ingest.collision_ids``, which writes one narrow table.
"""

KEY = ["type_key", "id"]
