"""Spark-native refresh of a supply-chain network model.

Layers, bottom up: ``functions`` (column expressions), ``operators`` (keyed
update, lookups, quality rules, reconciliation), ``sources`` (readers, staged
writers), ``plans`` (one module per business step, and the whole refresh).
"""

from lanewright.specs import MODEL_TABLES, SIDE_INPUTS, Params

__all__ = ["MODEL_TABLES", "SIDE_INPUTS", "Params"]
