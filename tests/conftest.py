import io
import sys
import tempfile
import zipfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

from docsift.session import configure  # noqa: E402

# A mail with an encoded subject, a copy to two people, and the same short note in quoted-printable Latin-1.
NOTE_ID = "n-0042.harbour@ledger.example"
SMALL_MAIL = (
    b"MIME-Version: 1.0\n"
    b"Subject: =?utf-8?q?Kr=C3=A4ne_am_Kai?= 7\n"
    b"To: \"Quay, Office\" <office@quay.example>\n"
    b"Cc: Ida <ida@quay.example>, lars@dock.example\n"
    b"Content-Transfer-Encoding: quoted-printable\n"
    b"Content-Type: text/plain; charset=iso-8859-1; format=flowed\n"
    b"From: Mia Voss <mia@ledger.example>\n"
    b"X-Berth: 12b\n"
    b"Date: Sat, 30 Nov 2019 23:15:09 +0545\n"
    b"Message-ID: <" + NOTE_ID.encode() + b">\n"
    b"\n"
    b"Zwei Kr=E4ne & ein Boot\n"
    b"fehlen =3D 3 < 4\n"
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("docsift-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docsift-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def make_zip(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries:
            archive.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def roots(spark, rows, schema="root_id string, name string, content binary"):
    return spark.createDataFrame([tuple(bytearray(v) if isinstance(v, bytes) else v for v in row) for row in rows], schema)


def values(spark, rows, schema, column):
    """Evaluate one column over literal rows, in their order."""
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [row.v for row in frame.select("i", column.alias("v")).orderBy("i").collect()]
