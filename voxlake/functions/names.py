"""Names and paths: what file names, directories and configuration lines say, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One extension is stripped, the first that fits.
DISCOVER_SUFFIXES = r"(\.nii\.gz|\.nii|\.gz)$"
PRUNE_SUFFIXES = r"(\.nii\.gz|\.nii|\.gz|\.csv|\.json|\.trm|\.minf)$"
PURGE_SUFFIXES = r"(\.nii\.gz|\.nii|\.gz|\.minf)$"
#: Ours: a header file loses both of its suffixes.
ALL_SUFFIXES = r"(\.(nii|gz|trm|csv|json))*(\.minf)?$"
#: Fixed value: region, then hemisphere, each ended by _ or --.
EMBEDDING_NAME = r"^_?(.*?)(?:--|_)(left|right)(?:--|_).*_embeddings\.csv$"
MODEL_ID = r"(name\d{2}-\d{2}-\d{2}--\d+)"
#: A crops path below a derivatives folder; archive suffixes.
CROPS_PATH = r"(derivatives/)([^/\n]+)(/crops(?:/[^/\n]+)*/2mm)"
ARCHIVES = r"\.(tar\.xz|tar\.gz|tgz|gz|zip)$"
DEFAULT_MASKS = "canonical_25"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(name: Column, suffixes: str = ALL_SUFFIXES) -> Column:
    return F.regexp_replace(name, suffixes, "")


def embedding_region(name: Column) -> Column:
    """The region in the name of an embedding table; null if the name isn't one."""
    return F.nullif(F.replace(F.regexp_extract(name, EMBEDDING_NAME, 1), F.lit("--"), F.lit("_")), F.lit(""))


def embedding_hemi(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, EMBEDDING_NAME, 2), F.lit(""))


def region_of(folder: Column) -> Column:
    """The region of a folder named region_left or region_right."""
    return F.nullif(F.regexp_extract(folder, "^(.*)_(left|right)$", 1), F.lit(""))


def hemi_of(folder: Column) -> Column:
    return F.nullif(F.regexp_extract(folder, "^(.*)_(left|right)$", 2), F.lit(""))


def graph_hemi(name: Column) -> Column:
    """right if the lower-cased name starts with r or holds _r or right; otherwise left."""
    low = F.lower(name)
    return F.when(low.startswith("r") | low.contains("_r") | low.contains("right"), "right").otherwise("left")


def bare_sulcus(name: Column, side: Column) -> Column:
    return F.replace(name, F.concat(F.lit("_"), F.when(side == "L", "left").otherwise("right")), F.lit(""))


def complete_sulcus(name: Column, side: Column) -> Column:
    return F.concat(name, F.when(side == "L", "_left").otherwise("_right"))


def dataset_name(region: Column, side: Column) -> Column:
    return F.concat(F.translate(region, ".", ""), F.when(side == "L", "_left").otherwise("_right"))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """The template with every placeholder replaced by its value."""
    for name, value in values.items():
        template = F.replace(template, F.lit(name), value.cast("string"))
    return template


def derivatives_folder(legacy: Column, published: Column, version: Column) -> Column:
    """The folder that the published models were made in for legacy runs, otherwise that of the version."""
    return F.when(legacy, published).otherwise(version)


def rewrite_derivatives(line: Column, folder: Column) -> Column:
    """The line with the folder below derivatives/ replaced in crops paths."""
    return F.regexp_replace(line, F.lit(CROPS_PATH), F.concat(F.lit("$1"), folder, F.lit("$3")))


def parent_of(path: Column, component: str) -> Column:
    """The path above a named component; null if it has none."""
    parts = F.split(path, "/")
    at = F.array_position(parts, component)
    return F.when(at > 0, F.array_join(F.slice(parts, F.lit(1), (at - 1).cast("int")), "/"))


def relative_path(path: Column, root: Column) -> Column:
    """An absolute path as seen from an absolute folder, by steps up where it lies elsewhere."""
    a, b = F.filter(F.split(path, "/"), lambda x: x != ""), F.filter(F.split(root, "/"), lambda x: x != "")
    same = F.aggregate(F.sequence(F.lit(0), F.size(b)), F.lit(0), lambda n, i: F.when((n == i) & F.get(a, i).isNotNull() & (F.get(a, i) == F.get(b, i)), n + 1).otherwise(n))
    steps = F.concat(F.array_repeat(F.lit(".."), F.size(b) - same), F.slice(a, same + 1, F.greatest(F.size(a) - same, F.lit(0))))
    return F.when(F.size(steps) == 0, ".").otherwise(F.array_join(steps, "/"))


def nth_parent(path: Column, n: Column) -> Column:
    """The n-th parent of an absolute path, at most the first component, which then ends in a slash."""
    parts = F.split(path, "/")
    return F.when(n >= F.size(parts) - 3, F.concat(F.lit("/"), F.element_at(parts, 2), F.lit("/"))).otherwise(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - n), "/"))


def bucket_label(distance: Column) -> Column:
    low = F.floor(distance)
    return F.concat(low.cast("string"), F.lit("-"), (low + 1).cast("string"), F.lit("vox"))


def voxel_folder(size: Column) -> Column:
    return F.concat(size.cast("int").cast("string"), F.lit("mm"))


def pair_label(name: Column) -> Column:
    return F.regexp_replace(name, r"_embeddings\.csv$", "")


def source_kind(source: Column, hub: str) -> Column:
    """hub (a URL of the host `hub`, or owner/name), archive (a URL of an archive), or local."""
    remote = source.rlike("^(https?|ftp)://")
    return (
        F.when(source.rlike("^https?://") & F.parse_url(source, F.lit("HOST")).contains(hub), "hub")
        .when(remote & source.rlike(ARCHIVES), "archive")
        .when(~remote & source.contains("/") & ~source.startswith("/") & ~source.rlike(ARCHIVES), "hub")
        .otherwise("local")
    )


def hub_id(source: Column, hub: str) -> Column:
    path = F.split(F.regexp_replace(F.parse_url(source, F.lit("PATH")), "^/+|/+$", ""), "/")
    return F.when(source.rlike("^https?://") & F.parse_url(source, F.lit("HOST")).contains(hub), F.array_join(F.slice(path, 1, 2), "/")).otherwise(source)


def merged_config(base: Column, patch: Column) -> Column:
    """A map of settings with those of `patch` put in; unknown keys stay."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(patch, k)), patch)


def masks_version(config: Column) -> Column:
    return F.coalesce(F.nullif(F.try_element_at(config, F.lit("masks_version")), F.lit("")), F.lit(DEFAULT_MASKS))
