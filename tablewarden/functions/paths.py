"""Column expressions over file paths and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions that hold recordings, media or documents, never tables.
RAW_EXTENSIONS = [
    "edf", "bdf", "acq", "gdf", "rec", "cnt", "vhdr", "vmrk", "eeg", "mff", "set", "fdt", "fif", "nii", "img",
    "hdr", "mgh", "mgz", "mnc", "dcm", "c3d", "trc", "mot", "sto", "mat", "h5", "hdf5", "hdf", "nc", "cdf", "npy",
    "npz", "pkl", "pickle", "asc", "wav", "mp3", "flac", "ogg", "m4a", "aiff", "aif", "au", "wma", "mp4", "avi",
    "mov", "mkv", "wmv", "m4v", "flv", "webm", "3gp", "bin", "raw", "pdf", "docx", "doc", "odt", "rtf",
]

# Extensions counted as tables when a folder is judged.
TABLE_EXTENSIONS = ["csv", "tsv", "txt", "dat", "xlsx", "xls", "sav", "dta", "sas7bdat", "rds", "rda", "rdata"]

# Extensions whose type never depends on an outside answer.
EXTENSION_TYPES = {
    "code": ["r", "qmd", "ipynb", "do", "sps", "sas"],
    "software": [
        "exe", "dmg", "app", "jar", "msi", "deb", "rpm", "sh", "bash", "zsh", "bat", "cmd", "ps1", "dll", "so",
        "dylib", "lib", "lua", "psyexp", "osexp", "opensesame",
    ],
    "output": ["spv", "fig"],
}

# Folder names of language tooling (any size) and of build trees (size-gated).
TOOL_FOLDERS = [
    "__pycache__", ".git", ".Rproj.user", "renv", "node_modules", "site-packages", "venv", ".venv", "packrat",
    ".ipynb_checkpoints", "bower_components", "jspm_packages", "__pypackages__", ".pytest_cache", ".mypy_cache",
]
BUILD_FOLDERS = ["lib", "libs", "src", "build", "dist", "vendor"]

# Names that stand for one participant.
PARTICIPANT_PATTERNS = [
    r"^\d+$",
    r"^sub\d+",
    r"^subj\d+",
    r"^s\d{2,}$",
    r"^p\d+",
    r"^id\d+",
    r"^participant[\s_-]?\d+",
    r"^pp\d+",
    r"^vp\d+",
]

# File types an answer may carry.
FILE_TYPES = [
    "data", "codebook", "code", "software", "output", "supplemental", "readme", "asset", "other", "llm_error",
]
SENTINEL = "llm_error"
GROUP_PATTERN = r"^(ex|pilot)\d+\w*$|^shared$"

# Words in the names of narrative documents.
NARRATIVE_PATTERN = (
    r"manuscript|preregistr|registered.report|thesis|dissertation"
    r"|_report\.|_report_|report\.pdf|proposal|protocol"
)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Everything before the last slash; empty at the root."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ext(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"\.([A-Za-z0-9]+)$", 1))


def ext_or_none(path: Column) -> Column:
    e = ext(path)
    return F.when(e == "", F.lit("(none)")).otherwise(e)


def stem(path: Column) -> Column:
    """The file name without its extension; a name that is only a dot and letters stays."""
    return F.regexp_replace(basename(path), r"([^.])\.[A-Za-z0-9]+$", "$1")


def ancestors(path: Column) -> Column:
    """Every folder above ``path``, outermost first: ``a/b/c.txt`` → ``[a, a/b]``."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    return F.when(
        depth > 0,
        F.transform(
            F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
            lambda i: F.array_join(F.slice(parts, 1, i), "/"),
        ),
    ).otherwise(F.array().cast("array<string>"))


def is_git_internal(path: Column) -> Column:
    return path.rlike(r"(^|/)\.git(/|$)")


def data_format(extension: Column) -> Column:
    return F.when(extension.isin(RAW_EXTENSIONS), F.lit("raw")).otherwise(F.lit("tabular"))


def is_participant_id(name: Column) -> Column:
    pattern = "(?i)" + "|".join(f"(?:{p})" for p in PARTICIPANT_PATTERNS)
    return F.coalesce(name.rlike(pattern), F.lit(False))


def infer_group(text: Column) -> Column:
    """``Pilot 2`` → ``pilot2``, ``Experiment 1`` / ``Study 2a`` → ``ex1`` / ``ex2a``."""
    pilot = F.lower(F.regexp_extract(text, r"(?i)pilot\s*(\d+[a-z]?)", 1))
    study = F.lower(F.regexp_extract(text, r"(?i)(experiment|study)\s*(\d+[a-z]?)", 2))
    return F.when(pilot != "", F.concat(F.lit("pilot"), pilot)).when(
        study != "", F.concat(F.lit("ex"), study)
    )


def valid_type(value: Column) -> Column:
    return F.coalesce(value.isin(FILE_TYPES), F.lit(False))


def valid_group(value: Column) -> Column:
    return F.coalesce(value.rlike(GROUP_PATTERN), F.lit(False))


def clean_group(value: Column) -> Column:
    return F.when(valid_group(value), value).otherwise(F.lit("shared"))


def type_from_extension(extension: Column) -> Column:
    """The fixed type of an extension, null where none is fixed."""
    out = F.lit(None).cast("string")
    for kind, names in EXTENSION_TYPES.items():
        out = F.when(extension.isin(names), F.lit(kind)).otherwise(out)
    return out


def is_readme(filename: Column) -> Column:
    return F.lower(filename).rlike(r"^readme($|\.)")


def is_narrative(filename: Column) -> Column:
    return F.lower(filename).rlike(NARRATIVE_PATTERN)


def group_scope(group: Column) -> Column:
    return F.when(group.rlike("^shared"), F.lit("shared")).otherwise(F.lit("experiment-specific"))


def repository_host(paper_id: Column) -> Column:
    return F.when(F.startswith(paper_id, F.lit("doi_")), F.lit("dataverse")).otherwise(F.lit("osf"))


def safe_id(raw: Column) -> Column:
    return F.regexp_replace(raw, "[:/]", "_")


def rebuild_path(root: str, source: Column, paper_id: Column, rel_path: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), source, paper_id, rel_path)


def export_keyword(name: Column, limit: int = 60) -> Column:
    """Letters and digits of the name without its extension, at most ``limit``."""
    return F.substring(
        F.regexp_replace(stem(name), "[^a-zA-Z0-9]", ""), 1, limit
    )


def export_filename(filename: Column, individual: Column, sheet: Column, position: Column) -> Column:
    """``[granularity-individual_]source-<keyword>[_sheet-<keyword>]_data.csv``."""
    kw = export_keyword(filename)
    kw = F.when(kw == "", F.concat(F.lit("file"), position.cast("string"))).otherwise(kw)
    return F.concat(
        F.when(individual, F.lit("granularity-individual_")).otherwise(F.lit("")),
        F.lit("source-"),
        kw,
        F.when(
            F.coalesce(sheet, F.lit("")) != "", F.concat(F.lit("_sheet-"), export_keyword(sheet))
        ).otherwise(F.lit("")),
        F.lit("_data.csv"),
    )


def folder_words(name: Column, max_words: int = 5) -> Column:
    """A folder name reduced to its first words, joined by underscores."""
    words = F.transform(
        F.split(F.trim(name), r"\s+"), lambda w: F.regexp_replace(w, r"[^A-Za-z0-9_\-]", "")
    )
    return F.array_join(F.slice(F.filter(words, lambda w: w != ""), 1, max_words), "_")


def folder_name(name: Column, max_words: int = 5) -> Column:
    """``folder_words``, with a digest of the name where that loses a part of it: no two names share a folder."""
    short = folder_words(name, max_words)
    whole = short == F.replace(name, F.lit(" "), F.lit("_"))
    return F.when(whole, short).otherwise(F.concat(short, F.lit("-"), F.substring(F.md5(name), 1, 12)))
