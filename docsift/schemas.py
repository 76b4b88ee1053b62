"""Table contracts: nested types, and tables in Spark DDL."""

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

_TEXT, _FLAG = StringType(), BooleanType()

ADDRESS = StructType().add("name", _TEXT).add("address", _TEXT)
GROUP = StructType().add("name", _TEXT).add("addresses", ArrayType(ADDRESS))
HEADER = (
    StructType()
    .add("name", _TEXT)
    .add("raw_name", _TEXT)
    .add("raw", _TEXT)
    .add("kind", _TEXT)
    .add("text", _TEXT)
    .add("texts", ArrayType(_TEXT))
    .add("addresses", ArrayType(ADDRESS))
    .add("groups", ArrayType(GROUP))
)
PART = (
    StructType()
    .add("part_id", IntegerType())
    .add("parent", IntegerType())
    .add("ctype", _TEXT)
    .add("subtype", _TEXT)
    .add("kind", _TEXT)
    .add("name", _TEXT)
    .add("is_attachment", _FLAG)
    .add("in_html_body", _FLAG)
    .add("in_text_body", _FLAG)
    .add("length", LongType())
    .add("text", _TEXT)
)
PARSED_MAIL = StructType().add("headers", ArrayType(HEADER)).add("parts", ArrayType(PART)).add("error", _TEXT)
_MESSAGE = f"headers array<{HEADER.simpleString()}>, parts array<{PART.simpleString()}>"

JOBS = "job_id string, input_uri string, output_uri string, mimetype string, types array<string>, recurse boolean"

# Where a content is that is too large for a value, and its digests.
STORED = "stored struct<location:string,sha256:string,md5:string>"

# One row per file to process. Roots have no parent and an empty chain. ``decoded`` is the text of a mail's attachment whose
# declared charset is not UTF-8. A file has its bytes in ``content``, or if they are many in a file of their own.
FILES = (
    "job_id string, root_id string, file_id string, parent_id string, depth int, ordinal bigint, "
    "id_chain array<string>, name string, mimetype string, checksum string, length bigint, "
    f"types array<string>, recurse boolean, decoded string, content binary, {STORED}"
)

# What one pass over a large content tells (see ``sources.contents``).
LOOK = "length bigint, checksum string, mail_checksum string, magic string, plain boolean, sha256 string, md5 string"
LOOK_STRUCT = f"struct<{','.join(':'.join(field.split()) for field in LOOK.split(', '))}>"

# What the container job hands to the native columns: children, parsed messages and errors in one pass. A large child has a
# ``location`` and what was seen of its bytes in place of its ``content``.
EXPANDED = (
    "job_id string, root_id string, file_id string, depth int, id_chain array<string>, name string, "
    "mimetype string, checksum string, types array<string>, recurse boolean, "
    "record string, ordinal bigint, child_name string, ctype string, subtype string, decoded string, content binary, "
    f"location string, look {LOOK_STRUCT}, {_MESSAGE}, error_class string, message string"
)

# One expansion level as written: files found (containers and leaves apart), parsed messages and errors, by ``record``.
LEVEL = (
    f"{FILES}, {_MESSAGE}, error_class string, message string, "
    "level int, record string"
)

OUTPUTS = (
    "job_id string, root_id string, file_id string, depth int, ordinal bigint, kind string, process_type string, "
    "name string, mimetype string, checksum string, id_chain array<string>, archive_path string, length bigint, text string, "
    f"content binary, {STORED}"
)

ERRORS = (
    "job_id string, root_id string, file_id string, stage string, process_type string, error_class string, "
    "message string"
)

PROCESS_TYPES = ("text", "metadata", "pdf", "embedded")
MAIL = "message/rfc822"
MBOX = "application/mbox"
ZIP = "application/zip"
OCTETS = "application/octet-stream"
