"""Secret scan with multipart credential linking. DataFrame functions only.

Parts of a text, each with its span in code points:

* strong (the base kinds): ``assign`` (a secret's name, a separator, a value of 12 characters or
  more), ``access`` (AKIA identifiers of 18 or more), ``hex`` (runs of 16 or more);
* weak candidates: ``weak`` (any non-empty value assigned to one of the names above or to another
  name of a secret, such as secret_access_key, access_key, pwd or pass, where no ``assign`` covers it
  to its end and the value is no AKIA identifier), ``token`` (a free-standing run of 32 or more
  base64 characters with both cases and digits, outside URLs), ``login`` (an assigned user, login,
  account or client identifier), ``endpoint`` (a URL).

A weak candidate alone is prose. It is reported only if a part that completes it lies in its scope,
``SCOPE`` code points to either side: a weak secret needs an identity (access, login) or an
endpoint outside its own span, a login or an endpoint needs a secret (assign, hex, weak, token). The
scopes are intervals, and the linking is an interval join: parts are keyed by document and by the
bins of ``SCOPE`` code points that they touch, so a bin holds a bounded number of parts however long
the text.

Positions come from two built-ins that cut a text at the same matches: the pieces between matches
and the matches themselves; a running sum of their lengths per document and kind gives starts.
Only rows with a match are exploded and shuffled, and only lengths of them, no secrets.

Defined results: null text is empty, without spans. Rows are told apart by id and a hash of the
text; repeated rows get the same spans. Null ids are rows like others. Keyword letters match in either ASCII case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kardex.llm.common import stage, text_or_empty

SCOPE = 256
MASK = "[SECRET]"
BLOCK = 4096  # code points of a text that a redaction looks through at a time

# The three base patterns and the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# A run of 16 or more is a maximal run of that length: shorter runs are dropped anyway.
HEX = r"[0-9a-f]{16,}"
LOGIN = r"""(?i)\b(?:user(?:_?name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
ENDPOINT = r"""(?i)\bhttps?://[^\s"'<>]+"""
# Names of secrets (those of ASSIGN too) and any value; what a match must not be to count as weak.
NAMES = (r"(?:passw(?:or)?d|passphrase|passcode|secret|token|(?<![A-Za-z])(?:db|my|root|user|admin)?_?(?:pass|pwd)|credentials?|"
         r"(?:secret|access|private|account|shared|storage|master|auth|signing|encryption|service|api|consumer|client)[_-]?(?:access[_-]?|secret[_-]?)?key)")
WEAK = rf"""(?i){NAMES}["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*["']?[^\s"'`,;&<>()\[\]{{}}|]+"""
NOT_WEAK = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}$)|[:=>][\x20\t]*["']?AKIA[A-Z0-9]{14,}$"""
# A URL is taken whole first, so that no path counts as a token; group 1 is the token. Runs joined by
# - or _ need digits between letters, which words and dates do not have.
TOKEN = (r"""(?i:https?)://[^\s"'<>]+|("""
         r"(?<![A-Za-z0-9+/])(?=[A-Z0-9+/]*+[a-z])(?=[a-z0-9+/]*+[A-Z])(?=[A-Za-z/]*+[0-9+])[A-Za-z0-9+/]{32,}+={0,2}|"
         r"(?<![A-Za-z0-9_-])(?=[A-Z0-9_-]*+[a-z])(?=[a-z0-9_-]*+[A-Z])(?=[A-Za-z0-9_-]*?[A-Za-z][0-9]++[A-Za-z])[A-Za-z0-9_-]{32,}+={0,2})")
KINDS = ["assign", "access", "hex", "weak", "token", "login", "endpoint"]
SECRETS, IDENTITIES = ["assign", "hex", "weak", "token"], ["access", "login"]


def parts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The one pass over the texts, staged: id, text hash and the lengths of pieces and matches of
    each pattern (null where the pattern's quick test fails)."""
    t = text_or_empty(text)
    guards = {
        "assign": t.rlike(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
        "access": F.contains(t, F.lit("AKIA")),
        "hex": t.rlike("[0-9a-f]{16}"),
        "weak": t.rlike(r"""(?i)(?:passw(?:or)?d|passphrase|passcode|secret|token|key|pass|pwd|credentials?)["']?[\x20\t]*[:=]"""),
        "token": t.rlike("[A-Za-z0-9+/_-]{32}"),
        "login": t.rlike(r"""(?i)\b(?:user|login|account|client)[a-z_]*["']?\x20*[:=]"""),
        "endpoint": F.contains(t, F.lit("://")),
    }
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "weak": WEAK, "token": TOKEN, "login": LOGIN, "endpoint": ENDPOINT}

    def lengths(kind: str) -> Column:
        pattern, value_group = patterns[kind], {"assign": 2, "token": 1}.get(kind, 0)
        between = F.transform(F.split(t, pattern, -1), lambda x: F.length(x))
        whole = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
        measure = (lambda x: F.when(~x.rlike(NOT_WEAK), F.length(x)).otherwise(0)) if kind == "weak" else (lambda x: F.length(x))
        value = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(value_group)), measure)
        return F.arrays_zip(between.alias("gap"), whole.alias("len"), value.alias("value"))

    found = [F.when(guards[k], lengths(k)).alias(k) for k in patterns]
    return stage(docs.select(F.col(key).alias("doc_id"), text_hash(text).alias("text_hash"), *found), "parts")


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(text_or_empty(text))


def spans(found: DataFrame) -> DataFrame:
    """A row per part: id, text hash, kind, start, end."""
    patterns = ["assign", "access", "hex", "weak", "token", "login", "endpoint"]
    # Patterns of a kind as one array column, then one explode; equal rows count once.
    rows = found.where(F.coalesce(*patterns).isNotNull()).dropDuplicates(["doc_id", "text_hash"])
    kinds = F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(p).alias("hits")) for p in patterns))
    rows = rows.select("doc_id", "text_hash", F.explode(kinds).alias("k")).where("k.hits is not null")
    rows = rows.select("doc_id", "text_hash", "k.pattern", F.posexplode("k.hits").alias("nth", "hit")).where("hit.len is not null")
    run = Window.partitionBy("doc_id", "text_hash", "pattern").orderBy("nth")
    end = F.sum(F.col("hit.gap") + F.col("hit.len")).over(run)
    rows = rows.select("doc_id", "text_hash", "pattern", F.col("hit.len").alias("len"), F.col("hit.value").alias("value"), end.alias("end"))
    least = F.when(F.col("pattern") == "assign", 12).when(F.col("pattern") == "access", 18).otherwise(1)
    kind = F.when(F.col("value") >= least, F.col("pattern"))
    return rows.select("doc_id", "text_hash", kind.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end").where("kind is not null")


def link(all_spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak candidates that a complementary part completes: an interval join on bins."""
    s = all_spans.withColumn("role", F.when(F.col("kind").isin(SECRETS), "secret").when(F.col("kind").isin(IDENTITIES), "identity").otherwise("endpoint"))
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    weak = s.where(F.col("kind").isin("weak", "token", "login", "endpoint")).withColumn("bin", bins(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    needs = s.select(F.col("doc_id").alias("o_id"), F.col("text_hash").alias("o_hash"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
                     F.col("role").alias("o_role"), bins(F.col("start"), F.col("end")).alias("o_bin"))
    inside = (F.col("o_start") >= F.col("start")) & (F.col("o_end") <= F.col("end"))
    around = (F.col("o_start") <= F.col("start")) & (F.col("o_end") >= F.col("end"))
    completes = (F.when(F.col("role") == "secret", (F.col("o_role") != "secret") & ~inside)
                 .otherwise((F.col("o_role") == "secret") & ~around))
    near = (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_hash")) & (F.col("bin") == F.col("o_bin"))
    return weak.join(needs, same & near & completes, "left_semi").select("doc_id", "text_hash", "kind", "start", "end").distinct()


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, text hash and ``found``, the sorted spans (start, rank of the kind,
    end, kind, and ``seen``: the largest end of the spans before), strong ones and completed weak ones."""
    measured = parts(docs, key, text)
    every = stage(spans(measured), "spans")
    kept = every.where(F.col("kind").isin("assign", "access", "hex")).unionByName(link(every))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", rank, "end").rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("seen", F.coalesce(F.max("end").over(before), F.lit(0)))
    per_row = kept.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind", "seen"))).alias("found"))
    per_row = stage(per_row.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"), "found")
    joined = measured.select("doc_id", "text_hash").join(per_row, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    none = F.array().cast(per_row.schema["found"].dataType)
    return joined.select("doc_id", "text_hash", F.coalesce("found", none).alias("found"))


def listed(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, reported: DataFrame, key: str = "doc_id", text: str = "text", mask: str = MASK, length: str | None = None) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; overlapping spans give one mask.
    ``reported`` has a row per row of ``docs``. Column ``length``, if named, follows a text that
    changed. Rows travel as one struct, so their columns may have any names.

    A text is cut into blocks of ``BLOCK`` code points once; what stands between two spans is taken
    from the blocks that it touches, so the work is linear in the text and in its spans."""
    hits = reported.where(F.size("found") > 0).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "found")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(text).alias("body"), text_hash(text).alias("body_hash"))
    rows = rows.join(hits, F.col("key").eqNullSafe(F.col("id")) & (F.col("body_hash") == F.col("hash")), "left")
    blocks = F.when(F.col("found").isNotNull(), F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    part = (f"array_join(transform(sequence({{a}} div {BLOCK}, ({{b}} - 1) div {BLOCK}), k -> substring(blocks[cast(k as int)], "
            f"cast(greatest({{a}} - k * {BLOCK}, 0) + 1 as int), cast(least({{b}} - k * {BLOCK}, {BLOCK}) - greatest({{a}} - k * {BLOCK}, 0) as int))), '')")
    between = lambda a, b: f"if({b} > {a}, {part.format(a=a, b=b)}, '')"
    # ``seen`` is where the spans before end: a span that begins there or earlier continues their mask.
    piece = f"concat({between('s.seen', 's.start')}, if(s.start > s.seen or s.seen = 0, '{mask}', ''))"
    pieces = f"array_join(transform(filter(found, s -> s.end > s.seen), s -> {piece}), '')"
    tail = between("last", "length(body)")
    rows = rows.withColumn("blocks", blocks).withColumn("last", F.expr("array_max(transform(found, s -> s.end))"))
    rows = rows.withColumn("masked", F.when(F.col("found").isNull(), F.col("body")).otherwise(F.expr(f"concat({pieces}, {tail})")))
    row = F.col("row").withField(text, F.col("masked"))
    if length is not None:
        kind = docs.schema[length].dataType
        row = row.withField(length, F.when(F.col("masked").eqNullSafe(F.col("body")), F.col(f"row.`{length}`")).otherwise(F.length("masked").cast(kind)))
    return rows.select(row.alias("row")).select("row.*")
