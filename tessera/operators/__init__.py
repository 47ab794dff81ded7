"""Relational building blocks shared by the composed jobs in ``tessera.plans``."""

from tessera.operators import (cube, dims, intervals, ordered, profile, scores, sketches, tags, text,
                               topk)

__all__ = ["cube", "dims", "intervals", "ordered", "profile", "scores", "sketches", "tags", "text", "topk"]
