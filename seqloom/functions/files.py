"""Run files: names, kinds, lanes, reads, sizes and target paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The read types, the number each one gets in a dumped file name.
READ_TYPES = ("R1", "R2", "I1", "I2")
READ_NUMBERS = {"R1": 1, "R2": 2, "I1": 3, "I2": 4}
# Folder of a dumped file by file kind, folder of each stage.
DUMP_FOLDERS = {"fastq": "fastqs", "bam": "bams"}
STAGES = ("dumped_file", "count", "counted", "seurat", "integrated")


def path_basename(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def classify_filetype(path: Column) -> Column:
    """fastq, bam or unknown by the extension found in the path."""
    return (
        F.when(path.contains(".fastq") | path.contains(".fq"), F.lit("fastq"))
        .when(path.contains(".bam"), F.lit("bam"))
        .otherwise(F.lit("unknown"))
    )


def parse_filetype_name(name: Column) -> Column:
    """Stored spelling -> Fastq, Bam or Unknown."""
    return (
        F.when(name.isin("fastq", "Fastq"), F.lit("Fastq"))
        .when(name.isin("bam", "Bam"), F.lit("Bam"))
        .otherwise(F.lit("Unknown"))
    )


def parse_readtype_name(name: Column) -> Column:
    """R1, R2, I1, I2, or Unknown for any other text."""
    return F.when(name.isin(*READ_TYPES), name).otherwise(F.lit("Unknown"))


def parse_lane(filetype: Column, name: Column) -> Column:
    """`L00d` from the digit after `_L00` in a fastq name; null otherwise."""
    digit = _group(name, "_L00([0-9])")
    return F.when(F.lower(filetype) == "fastq", F.concat(F.lit("L00"), digit))


def parse_read_type(path: Column) -> Column:
    """Read type named in the path; Unknown when none or unsupported."""
    return parse_readtype_name(F.regexp_extract(path, "_([RI][0-9])", 1))


def parse_read_type_fallback(filetype: Column, name: Column) -> Column:
    """First of `_R`, `.R`, `_I`, `.I` found in a fastq name, with the character after it."""
    reads = [F.concat(F.lit(p[-1]), _group(name, rf"{p}(.)")) for p in ("_R", r"\.R", "_I", r"\.I")]
    return F.when(F.lower(filetype) == "fastq", F.coalesce(*reads))


def parse_size_gb(size: Column) -> Column:
    """`1.5T`, `3G`, `20M`, `7K` -> gigabytes; 0 without a unit, null if the number is unreadable."""
    amount = F.regexp_extract(size, "^([0-9.]+)", 1).try_cast("double")
    return (
        F.when(size.contains("T"), amount * 1024)
        .when(size.contains("G"), amount)
        .when(size.contains("M"), amount / 1024)
        .when(size.contains("K"), amount / 1024**2)
        .otherwise(F.lit(0.0))
    )


def bytes_to_gb(size: Column) -> Column:
    """Raw byte count -> gigabytes."""
    return size.cast("double") / 1024**3


def size_in(gb: Column, unit: str) -> Column:
    """A gigabyte column in TB, GB, MB or KB."""
    return {"TB": gb / 1024, "GB": gb, "MB": gb * 1024, "KB": gb * 1024**2}[unit]


def format_size(gb: Column) -> Column:
    return F.concat(gb.cast("string"), F.lit("G"))


def raw_filename(run: Column, filetype: Column, read: Column, path: Column) -> Column:
    """`{run}_{1..4}.fastq.gz` for a known fastq read, else the name in the path."""
    name = path_basename(path)
    for kind, number in READ_NUMBERS.items():
        numbered = F.concat(run, F.lit(f"_{number}.fastq.gz"))
        name = F.when((F.lower(filetype) == "fastq") & (read == kind), numbered).otherwise(name)
    return name


def dumped_filename(
    sample: Column,
    filetype: Column,
    tag: Column,
    lane: Column,
    read: Column,
    suffix: str = "_001",
    missing: str = "None",
) -> Column:
    """`{sample}_S{n}_{lane}_{read}_001.fastq.gz`, `{sample}.bam` or `{sample}.unknown`.

    A missing lane or read is written as `None`, which the checks of the run table look
    for. The newer form has an empty suffix and writes `Null`.
    """
    fastq = F.concat_ws("_", sample, tag, F.coalesce(lane, F.lit(missing)), F.coalesce(read, F.lit(missing)))
    return (
        F.when(F.lower(filetype) == "fastq", F.concat(fastq, F.lit(f"{suffix}.fastq.gz")))
        .when(F.lower(filetype) == "bam", F.concat(sample, F.lit(".bam")))
        .otherwise(F.concat(sample, F.lit(".unknown")))
    )


def dumped_path(sample_name: Column, sample: Column, filetype: Column, filename: Column) -> Column:
    """`{name}/0_dumped/{sample}/fastqs|bams/{file}`; null for an unknown kind (a reject)."""
    folder = F.lit(None).cast("string")
    for kind, name in DUMP_FOLDERS.items():
        folder = F.when(F.lower(filetype) == kind, F.lit(name)).otherwise(folder)
    return F.concat(sample_name, F.lit("/0_dumped/"), sample, F.lit("/"), folder, F.lit("/"), filename)


def stage_path(stage: str, root: str, series: Column, sample: Column, dumped: Column) -> Column:
    """Where a stage keeps its result."""
    base = F.concat(F.lit(f"{root}/resources/"), series)
    paths = {
        "dumped_file": F.concat(F.lit(f"{root}/resources/"), dumped),
        "count": F.concat(base, F.lit("/1_count")),
        "counted": F.concat(base, F.lit("/1_count/"), sample, F.lit("/out")),
        "seurat": F.concat(base, F.lit("/2_seurat/"), sample),
        "integrated": F.concat(base, F.lit("/2_seurat/__integrated")),
    }
    return paths[stage]


def _group(text: Column, pattern: str) -> Column:
    """First regex group, null when the pattern is not found."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))
