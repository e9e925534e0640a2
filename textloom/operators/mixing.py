"""Mixing a domain and a general dataset at exact ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx


def mix_counts(n_domain: int, n_general: int, domain_weight: float = 0.8, general_weight: float = 0.2, max_samples: int | None = None) -> tuple[int, int]:
    """How many rows to take of each. A side that runs short is not topped up from the other."""
    if general_weight <= 0:
        return (min(n_domain, max_samples) if max_samples else n_domain), 0
    whole = domain_weight + general_weight
    share_d, share_g = domain_weight / whole, general_weight / whole
    total = max_samples or int(n_domain / share_d)
    return min(int(total * share_d), n_domain), min(int(total * share_g), n_general)


def shuffled(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A reproducible order that does not depend on partitioning."""
    return rows.orderBy(tx.hash_rank(str(seed), F.col(key).cast("string")), key)


def mix_datasets(domain: DataFrame, general: DataFrame | None = None, domain_weight: float = 0.8, general_weight: float = 0.2, seed: int = 42, max_samples: int | None = None, key: str = "doc_id") -> DataFrame:
    """Samples without replacement by hash rank and concatenates; rows carry no order, see :func:`shuffled`."""
    general_weight = 0.0 if general is None else general_weight
    n_domain = domain.count()
    take_d, take_g = mix_counts(n_domain, general.count() if general_weight > 0 else 0, domain_weight, general_weight, max_samples)
    picked = domain if take_d >= n_domain else shuffled(domain, key, seed).limit(take_d)
    return picked.unionByName(shuffled(general, key, seed).limit(take_g)) if general_weight > 0 else picked
