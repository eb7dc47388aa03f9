"""Which parser reads which file, and the scan over a directory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import source_id

#: The extensions of each format family.
FAMILIES = {
    "plain": ["txt", "text", "log"],
    "markdown": ["md", "markdown", "mdx"],
    "delimited": ["csv", "tsv"],
    "json": ["json", "jsonl", "ndjson"],
    "yaml": ["yaml", "yml"],
    "code": ["py", "js", "ts", "tsx", "jsx", "java", "go", "rs", "rb", "php", "c", "h", "cpp", "hpp", "cs", "kt", "swift", "scala", "sh", "bash", "ps1", "sql", "toml", "ini", "cfg", "conf", "env", "dockerfile", "makefile"],
    "word": ["docx"],
    "sheet": ["xlsx", "xlsm"],
    "slides": ["pptx"],
    "pdf": ["pdf"],
    "web": ["html", "htm", "xhtml"],
    "image": ["png", "jpg", "jpeg", "webp", "bmp", "tiff", "tif"],
}
FAMILY = {ext: family for family, exts in FAMILIES.items() for ext in exts}


def supported_extensions() -> list[str]:
    return sorted(FAMILY)


def formats(spark: SparkSession) -> DataFrame:
    """format_type, family: one row per extension."""
    return spark.createDataFrame(sorted(FAMILY.items()), "format_type string, family string")


def scan(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """source, content of every file under a path (or of the file itself)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select(F.col("path").alias("source"), "content")


def identify(files: DataFrame) -> DataFrame:
    """files with source_id, filename, format_type (lower-case extension; of a URL html) and family (null: unsupported)."""
    name = F.regexp_extract("source", r"([^/]*)\z", 1)
    ext = F.lower(F.regexp_extract(name, r"(?<=.)\.([^.]+)\z", 1))
    kind = F.when(F.regexp_like("source", F.lit(r"\Ahttps?://")), F.lit("html")).otherwise(ext)
    table = F.create_map(*(F.lit(x) for pair in sorted(FAMILY.items()) for x in pair))
    return files.select(source_id(F.col("source")).alias("source_id"), "*").withColumns({"filename": name, "format_type": kind}).withColumn("family", F.try_element_at(table, "format_type"))


def unsupported(files: DataFrame) -> DataFrame:
    """Failure rows of identified files that no parser reads."""
    said = "Unsupported format '." + "{}" + "'. Supported: " + ", ".join(supported_extensions())
    before, after = said.split("{}")
    return files.where("family IS NULL").select("source", F.concat(F.lit(before), "format_type", F.lit(after)).alias("error"), F.lit("parse_error").alias("kind"))


def missing(spark: SparkSession, asked: list[str], files: DataFrame) -> DataFrame:
    """Failure rows of explicitly asked paths that the scan didn't find."""
    want = spark.createDataFrame([(a,) for a in asked], "source string")
    return want.join(files.select("source"), "source", "left_anti").select("source", F.concat(F.lit("File not found: "), "source").alias("error"), F.lit("parse_error").alias("kind"))
