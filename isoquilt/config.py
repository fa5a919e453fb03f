"""All tunables in one place; defaults are the values the reference results depend on."""

from dataclasses import dataclass


@dataclass(frozen=True)
class ReadConfig:
    """Read extraction."""

    toolkit: int = 5
    min_mapq: int = 30
    gene_flank: int = 200
    search_len: int = 55
    min_clip: int = 17
    polya_window: int = 20
    polya_count: int = 15
    polya_run: int = 10
    site_tolerance: int = 1


@dataclass(frozen=True)
class BarcodeConfig:
    """Barcode matching."""

    k: int = 8
    top: int = 8
    cos_thresh: float = 0.25
    mu: float = 20.0
    sigma: float = 10.0
    sigma_start: float = 10.0
    batch: int = 100
    alpha: float = 0.05
    max_edit: int = 6
    barcode_len: int = 16
    survival_cutoff: float = 0.05
    max_mean_edit: float = 1.5


@dataclass(frozen=True)
class UmiConfig:
    """UMI de-duplication, splice voting and size filtering."""

    barcode_len: int = 16
    umi_len: int = 10
    flank: int = 1
    sim_thresh: int = 5
    iso_thresh: int = 80
    cut_alpha: int = 3
    min_reads: int = 10
    site_thresh: int = 10
    mid_support: float = 1.5
    size_eps: int = 10
    size_alpha: float = 0.05
    edit_error: int = 2
    # Groups up to this many nodes are compared pairwise; larger ones go through
    # the signature join, which finds exactly the same pairs.
    pair_bound: int = 256
    # Groups up to this many edges are clustered inside one task; larger ones by
    # the distributed component and community jobs.
    task_edge_bound: int = 20000


@dataclass(frozen=True)
class ExonConfig:
    """Exon mapping and inclusion statistics."""

    bias: int = 5
    min_cover: int = 10
    min_share: float = 0.5
    exon_len: int = 10
    min_exprs: int = 10
    min_cells: int = 30
    iters: int = 100
    censored_min_reads: int = 5
    censored_min_cells: int = 20
