"""Fixed schemas of the files that travel between sites."""

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


# The eight fields of a change, in file order.
CHANGE_FIELDS = (
    "sTransNox", "sBranchCd", "sStatemnt", "sTableNme", "sDestinat", "sModified", "dEntryDte", "dModified",
)
CHANGE_TIMES = ("dEntryDte", "dModified")

CHANGE = T.StructType(
    [T.StructField(n, T.TimestampNTZType() if n in CHANGE_TIMES else T.StringType()) for n in CHANGE_FIELDS]
)

SYNC_REQUEST = T.StructType(_strings("sExportCd sClientID sExportFr sExportTr"))

# The ten fields of a field entry, in file order.
FIELD_ENTRY_FIELDS = (
    "sTransNox", "nEntryNox", "sAcctNmbr", "sRemCodex", "sJsonData",
    "dReceived", "sUserIDxx", "sDeviceID", "dModified", "dTimeStmp",
)
FIELD_ENTRY = T.StructType(_strings(" ".join(FIELD_ENTRY_FIELDS)))

DOCUMENT_REPLY = T.StructType(
    [
        T.StructField("result", T.StringType()),
        T.StructField("payload", T.StructType(_strings("filename data"))),
        T.StructField("error", T.StructType(_strings("code message"))),
    ]
)
