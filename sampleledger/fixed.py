"""Names, lists and patterns that the file and record formats prescribe."""

from __future__ import annotations

# --- Fixed values: record tables and record ids -----------------------------------------
RECORD_TABLES = (
    "Aliases",
    "Biospecimens",
    "CollectionBuffer",
    "MetabolomicsBatches",
    "Projects",
    "SequencingBatches",
    "SequencingPrep",
    "Sites",
    "Subjects",
    "Visits",
)
SNAPSHOT_FILE_PREFIX = "airtable_"
RECORD_ID_PATTERN = r"^rec[A-Za-z0-9]{14}$"

# --- Fixed values: name patterns --------------------------------------------------------
# Sample, well and suffix of an artefact name: on disk, and in an object store.
DISK_NAME_PATTERN = r"^([\w\-]+)_(S\d+)_?(.+)"
STORE_NAME_PATTERN = r"([\w\-]+)_(S\d{1,2})_?(.+)"
SEQUENCING_PREFIX = "SEQ"
OLD_NAME_PATTERN = r"F[EG]\d{5}"
VISIT_ID_PATTERN = r"^(SDM?)(\d+)([A-Z])$"
PROFILE_VERSION_PATTERN = r"mpa_v(\d+)_CHOCOPhlAn"
CLEANED_PAIR_PATTERN = r"([\w\-]+)_(S\d+)_kneaddata_paired"
FASTQ_PATTERN = r"(?i)\.(fastq|fq)(\.gz)?$"
OUTPUT_PREFIX_PATTERN = r"s3://.+/output/"
LISTING_ZONE = "America/New_York"

# --- Fixed values: the suffixes an artefact may have ------------------------------------
KNOWN_SUFFIXES = (
    "genefamilies.tsv",
    "pathabundance.tsv",
    "pathcoverage.tsv",
    "ecs.tsv",
    "kos.tsv",
    "pfams.tsv",
    "ecs_rename.tsv",
    "kos_rename.tsv",
    "pfams_rename.tsv",
    "kneaddata.log",
    "kneaddata.repeats.removed.1.fastq.gz",
    "kneaddata.repeats.removed.2.fastq.gz",
    "kneaddata.repeats.removed.unmatched.1.fastq.gz",
    "kneaddata.repeats.removed.unmatched.2.fastq.gz",
    "kneaddata.trimmed.1.fastq.gz",
    "kneaddata.trimmed.2.fastq.gz",
    "kneaddata.trimmed.single.1.fastq.gz",
    "kneaddata.trimmed.single.2.fastq.gz",
    "kneaddata_paired_1.fastq.gz",
    "kneaddata_paired_2.fastq.gz",
    "kneaddata_unmatched_1.fastq.gz",
    "kneaddata_unmatched_2.fastq.gz",
    "kneaddata_hg37dec_v0.1_bowtie2_paired_contam_1.fastq.gz",
    "kneaddata_hg37dec_v0.1_bowtie2_paired_contam_2.fastq.gz",
    "kneaddata_hg37dec_v0.1_bowtie2_unmatched_1_contam.fastq.gz",
    "kneaddata_hg37dec_v0.1_bowtie2_unmatched_2_contam.fastq.gz",
    "kneaddata_hg37_v0.1_bowtie2_paired_contam_1.fastq.gz",
    "kneaddata_hg37_v0.1_bowtie2_paired_contam_2.fastq.gz",
    "kneaddata_hg37_v0.1_bowtie2_unmatched_1_contam.fastq.gz",
    "kneaddata_hg37_v0.1_bowtie2_unmatched_2_contam.fastq.gz",
    ".log",
    ".sam.bz2",
    "bowtie2.tsv",
    "profile.tsv",
    ".sam",
)

# --- Fixed values: artefact flags and the flags each tool needs -------------------------
ARTEFACT_FLAGS = {
    "kneaddata_complete": "kneaddata.log",
    "has_taxprofile": "profile.tsv",
    "has_bowtie2": "bowtie2.tsv",
    "has_sam": ".sam.bz2",
    "has_genefamilies": "genefamilies.tsv",
    "has_pathabundance": "pathabundance.tsv",
    "has_pathcoverage": "pathcoverage.tsv",
    "has_ecs": "ecs.tsv",
    "has_kos": "kos.tsv",
    "has_pfams": "pfams.tsv",
    "has_ecs_rename": "ecs_rename.tsv",
    "has_kos_rename": "kos_rename.tsv",
    "has_pfams_rename": "pfams_rename.tsv",
}
COMPLETION_RULES = {
    "metaphlan_complete": ("has_taxprofile", "has_bowtie2", "has_sam"),
    "humann_basic_complete": ("has_genefamilies", "has_pathabundance", "has_pathcoverage"),
    "humann_complete": (
        "has_ecs", "has_kos", "has_pfams", "has_ecs_rename", "has_kos_rename", "has_pfams_rename",
    ),
}
TOOLS = ("kneaddata", "metaphlan", "humann")

# --- Fixed values: run versions and the marker file of each stage -----------------------
PROFILE_DATABASE = "mpa_vOct22_CHOCOPhlAnSGB_202403"
FUNCTION_VERSION_TAG = "HM40"
STAGE_MARKERS = {
    "clean_paired": ("{sample}_kneaddata.log",),
    "clean_single": ("{sample}_kneaddata_single.log",),
    "concat": ("{sample}.joined.fastq.gz",),
    "relab_profile": ("{sample}_{db}_RELAB_profile.tsv", "{sample}_{db}_bowtie2.tsv"),
    "stats_profile": ("{sample}_{db}_STATS_profile.tsv",),
    "genefamilies": ("{sample}_{tag}_2_genefamilies.tsv",),
}
OLDER_STAGE_MARKERS = {
    "clean": ("{sample}_kneaddata.log",),
    "profile": ("{sample}_profile.tsv",),
    "genefamilies": ("{sample}_genefamilies.tsv",),
    "regroup_kos": ("{sample}_kos.tsv",),
    "regroup_pfams": ("{sample}_pfams.tsv",),
    "regroup_ecs": ("{sample}_ecs.tsv",),
    "rename_kos": ("{sample}_kos_rename.tsv",),
    "rename_pfams": ("{sample}_pfams_rename.tsv",),
    "rename_ecs": ("{sample}_ecs_rename.tsv",),
}
#: What each stage reads: raw reads or what other stages leave. Stages stand after those they read.
STAGE_INPUTS = {
    "clean_paired": ("raw",),
    "clean_single": ("raw",),
    "concat": ("clean_paired", "clean_single"),
    "relab_profile": ("concat",),
    "stats_profile": ("relab_profile",),
    "genefamilies": ("concat", "relab_profile"),
    "regroup_rename": ("genefamilies",),
}
OLDER_STAGE_INPUTS = {
    "clean": ("raw",),
    "profile": ("clean",),
    "genefamilies": ("profile",),
    "regroup_kos": ("genefamilies",),
    "regroup_pfams": ("genefamilies",),
    "regroup_ecs": ("genefamilies",),
    "rename_kos": ("regroup_kos",),
    "rename_pfams": ("regroup_pfams",),
    "rename_ecs": ("regroup_ecs",),
}
EXPECTED_ARTEFACTS = {
    "relab_profile": "{sample}_{db}_RELAB_profile.tsv",
    "mapout": "{sample}_{db}_bowtie2.tsv",
    "samout": "{sample}_{db}.sam",
    "stats_profile": "{sample}_{db}_STATS_profile.tsv",
    "genefamilies": "{sample}_{tag}_2_genefamilies.tsv",
    "ecs": "{sample}_{tag}_ecs.tsv",
    "kos": "{sample}_{tag}_kos.tsv",
    "pfams": "{sample}_{tag}_pfams.tsv",
    "ecs_rename": "{sample}_{tag}_ecs_rename.tsv",
    "kos_rename": "{sample}_{tag}_kos_rename.tsv",
    "pfams_rename": "{sample}_{tag}_pfams_rename.tsv",
}
CLEANUP_WORDS = ("bowtie2", "trimmed", "repeats")

# --- Fixed values: special rows of a functional abundance table -------------------------
UNMAPPED = "UNMAPPED"
UNGROUPED = "UNGROUPED"
UNINTEGRATED = "UNINTEGRATED"
UNNAMED = "NO_NAME"

# --- Fixed values: header lines of profiles and functional tables -----------------------
PROFILE_COLUMNS_START = "#clade_name\t"
PROFILE_VALUE_COLUMN = "relative_abundance"
PROFILE_FILE_SUFFIX = r"_profile\.tsv"
DATABASE_LINE_PATTERN = r"^#[^\s/]+$"
TABLE_COLUMNS_PATTERN = r"^# [^\t]+\t"
ABUNDANCE_COLUMN_PATTERN = r"_(Abundance|Coverage)(-\w+)?$"
