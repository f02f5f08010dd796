"""DataFrame-to-DataFrame operators."""

from dimloom.operators.dedup import distinct_rows, one_per_key
from dimloom.operators.keys import dense_ids, lookup_id, number_rows

__all__ = ["dense_ids", "distinct_rows", "lookup_id", "number_rows", "one_per_key"]
