"""The commands as functions of DataFrames and a configuration: none reads or writes a path by itself (see :mod:`tilewright.sources`)."""

from __future__ import annotations

from collections.abc import Callable


def commands() -> dict[str, Callable]:
    """Every command by its name."""
    from tilewright.commands import analysis, features, tiling

    return {
        "annotate": analysis.annotate, "cache_tiles": tiling.cache_tiles, "extract_features": features.extract_features, "aggregate_slide_features": features.aggregate_slide_features,
        "aggregate_sample_features": features.aggregate_sample_features, "filter_features": features.filter_features, "filter_tessellate": tiling.filter_tessellate, "tessellate": tiling.tessellate,
        "model_patch_sizes": features.model_patch_sizes, "derive_tile_grid": tiling.derive_tile_grid, "tessellate_extract_features": features.tessellate_extract_features,
        "create_class_embeddings": analysis.create_class_embeddings, "merge_annotation_features": analysis.merge_annotation_features, "linear_probe_benchmark": analysis.linear_probe_benchmark,
        "clustering_benchmark": analysis.clustering_benchmark, "abmil_benchmark": analysis.abmil_benchmark, "export_tiles": tiling.export_tiles, "convert": tiling.convert,
    }
