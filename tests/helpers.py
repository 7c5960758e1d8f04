from datetime import datetime

LOG = (
    "sTransNox string, sBranchCd string, sStatemnt string, sTableNme string, sDestinat string, sModified string, "
    "dEntryDte timestamp_ntz, dModified timestamp_ntz"
)
OUTGOING = (
    "sFileName string, sLogFromx string, sLogThrux string, sFileSize string, sMD5Hashx string, cTranStat string, "
    "dCreatedx timestamp_ntz, dExported timestamp_ntz"
)
CLIENT = "sClientID string, sClientNm string, sBranchCd string, sExportNo string"


def day(n: int, hour: int = 0) -> datetime:
    return datetime(2001, 5, n, hour)


def change(key, owner=None, table="T1", dest=None, by="U1", modified=None):
    owner = key[:4] if owner is None else owner
    return (key, owner, f"UPDATE {table} SET a=1", table, dest, by, day(1), modified or day(1))


def batch(name, first, last, state, made, exported=None, md5="aa"):
    return (name, first, last, "1.00", md5, state, made, exported)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
