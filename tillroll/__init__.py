"""tillroll: a retail order-line warehouse built on Spark DataFrames.

Layers: bronze (raw, typed) -> silver (cleaned, deduplicated) -> gold (date
dimension, five business dimensions with dense surrogate keys, sales fact)
-> six reporting views and fifteen business measures.

Everything is a lazy DataFrame transformation; the only actions are the
writes in :mod:`tillroll.plans.pipeline` and the optional checks.
"""

from tillroll.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
