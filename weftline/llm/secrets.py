"""Secret scans: fixed patterns, and Markov models of random strings and ordinary identifiers.

Two first-order character models are trained from labelled samples; a long run of key characters is a secret if it is
likelier, by transition, as a random string than as an identifier. All of it is DataFrame functions.

The samples are random strings by rule (digests in several alphabets), the values that the fixed patterns find, and the
words of about ``SAMPLE_DOCS`` distinct documents, drawn by a hash of doc_id and text, with some common identifiers.

Defined results: a null or empty text has no spans; positions are code points, ends exclusive; repeated rows are scanned
each for itself; texts of any length are scanned whole; further columns pass through, also under the names of the results,
which then get a ``_`` before them; an empty table gives no rows (the models then come from the fixed samples alone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.core import fresh, load

# fixed values: kind, pattern, the group whose length counts, its least length
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA)([A-Z0-9]+)", 0, 20),
    ("hex", r"()([0-9a-f]+)", 0, 24),
)
#: Gates that find the same texts sooner: maximal runs reach the least length or not.
GATES = {"assign": BASE[0][1], "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
MARKOV = "markov"
LEAST_RUN = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET)
SAMPLE_DOCS = 4000
RANDOM_ROWS = 2000
SMOOTHING = 0.5
LEAST_RATIO = 0.35  # mean log-likelihood ratio of a transition

# fixed values: ordinary identifiers
IDENTIFIERS = """
get_user_name set_default_value max_retry_count is_valid_email_address total_number_of_items application_configuration
readOnlyFileSystem createNewDocument updateUserProfile HttpRequestHandler ConnectionPoolManager AbstractFactoryBuilder
MAX_BUFFER_SIZE DEFAULT_TIMEOUT_SECONDS ENABLE_VERBOSE_LOGGING src/main/java/org/example/application/Controller
path/to/the/output/directory usr/local/share/documentation content-security-policy access-control-allow-origin
background-color-and-border user_authentication_service internationalization characteristically
responsibilities incomprehensibility telecommunications straightforwardness counterrevolutionary
lib/python/site-packages/example/package/module test_returns_empty_list_when_no_rows_match last_modified_timestamp
numberOfConcurrentConnections shouldReturnNullWhenInputIsEmpty calculate_moving_average_over_window
========================================== ------------------------------------------ __________________________________________
""".split()


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, kind>> of the pattern's leftmost matches whose group is long enough.

    Matches have no places in SQL, but splitting by the same pattern gives what stands between them, and the lengths of
    both add up to the places. Adding up runs over stretches of about the root of their number, first whole and then
    one by one, so that no list grows by one for each match of a long text.
    """
    matches, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(F.split(text, pattern, -1), matches, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("own")))
    steps = F.zip_with(steps, values, lambda s, v: F.struct(s["gap"].alias("gap"), s["own"].alias("own"), F.length(v).alias("size")))
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def step(acc, s):
        begin = acc["at"] + s["gap"]
        span = F.struct(begin.alias("start"), (begin + s["own"]).alias("end"), F.lit(kind).alias("kind"))
        return F.struct((begin + F.coalesce(s["own"], F.lit(0))).alias("at"), F.when(s["size"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def placed(part, begin):
        return F.aggregate(part, F.struct(begin.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def in_stretches(all_steps):
        size = F.ceil(F.sqrt(F.size(all_steps))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(all_steps) / size).cast("int") - 1), lambda k: F.slice(all_steps, k * size + 1, size))

    def begins(stretches):
        long = lambda part: F.aggregate(part, F.lit(0), lambda n, s: n + s["gap"] + F.coalesce(s["own"], F.lit(0)))
        return F.aggregate(F.transform(stretches, long), F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))

    joined = lambda stretches, at: F.flatten(F.zip_with(stretches, F.slice(at, F.lit(1), F.size(stretches)), placed))
    return let(steps, lambda s: let(in_stretches(s), lambda stretches: let(begins(stretches), lambda at: joined(stretches, at))))


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,kind:string>>")


def base_spans(text: Column) -> Column:
    found = [F.when(text.rlike(GATES[kind]), spans_of(text, kind, pattern, group, least)).otherwise(none()) for kind, pattern, group, least in BASE]
    return F.concat(*found)


def labelled_samples(spark: SparkSession, docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(sample, random): strings to learn from."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    raw = F.unhex(digest)
    by_rule = spark.range(RANDOM_ROWS).select(F.explode(F.array(digest, F.hex(raw), F.base64(raw), F.translate(F.base64(raw), "+/", "-_"), F.conv(F.substring(digest, 1, 15), 16, 36))).alias("sample"), F.lit(True).alias("random"))
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, IDENTIFIERS))).alias("sample"), F.lit(False).alias("random"))
    drawn = docs.select("text", F.pmod(F.xxhash64(F.lit("secrets"), F.col("doc_id").cast("string"), "text"), F.lit(1 << 40)).alias("draw"))
    total = drawn.agg(F.approx_count_distinct("draw")).first()[0]
    some = drawn.where(F.col("draw") < int(min(1.0, sample_docs / max(1, total)) * (1 << 40))).dropDuplicates(["draw"]).select("text")
    values = F.concat(*[F.when(F.col("text").rlike(GATES[kind]), F.filter(F.regexp_extract_all("text", F.lit(p), F.lit(2)), lambda v: (F.length(v) >= 20) & v.rlike("[0-9]"))).otherwise(F.array().cast("array<string>")) for kind, p, _, _ in BASE])
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{3,40}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    each = F.concat(F.transform(values, lambda v: F.struct(v.alias("sample"), F.lit(True).alias("random"))), F.transform(words, lambda v: F.struct(v.alias("sample"), F.lit(False).alias("random"))))
    return by_rule.union(fixed).union(some.select(F.inline(each)))


def place(c: Column) -> Column:
    """Where a character stands in the alphabet, from 1 (0: nowhere)."""
    return F.call_function("locate", c, F.lit(ALPHABET))


def train(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """log P(b|a) of random strings minus that of ordinary ones, for every pair (a, b) of the alphabet, a major."""
    chars = samples.select("random", F.regexp_extract_all("sample", F.lit("."), F.lit(0)).alias("c"))
    pairs = chars.select("random", F.explode(F.zip_with(F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))), F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    counts = pairs.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("random", place(F.col("a")).alias("a"), place(F.col("b")).alias("b"), "n").where("a > 0 and b > 0")
    wide = counts.groupBy("a", "b").agg(F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("r"), F.sum(F.when(F.col("random"), 0).otherwise(F.col("n"))).alias("o"))
    grid = samples.sparkSession.range(SIZE * SIZE).select((F.floor(F.col("id") / SIZE) + 1).cast("int").alias("a"), (F.col("id") % SIZE + 1).cast("int").alias("b"))
    full = grid.join(wide, ["a", "b"], "left").select("a", "b", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("o", F.lit(0)).alias("o"))
    rows = full.groupBy("a").agg(F.sum("r").alias("tr"), F.sum("o").alias("to"), F.collect_list(F.struct("b", "r", "o")).alias("cells"))
    one = lambda n, total: F.log((n + smoothing) / (total + smoothing * SIZE))
    ratios = rows.select("a", F.transform(F.array_sort("cells"), lambda c: one(c["r"], F.col("tr")) - one(c["o"], F.col("to"))).alias("row"))
    table = ratios.agg(F.array_sort(F.collect_list(F.struct("a", "row"))).alias("rows")).select(F.flatten(F.transform("rows", lambda x: x["row"])).alias("table"))
    return table.first()["table"]


def markov_score(run: Column, table: Column) -> Column:
    """The mean log-likelihood ratio of a run's transitions."""
    at = F.transform(F.regexp_extract_all(run, F.lit("."), F.lit(0)), place)
    n = F.size(at) - 1
    ratios = F.zip_with(F.slice(at, F.lit(1), n), F.slice(at, F.lit(2), n), lambda a, b: F.element_at(table, (a - 1) * SIZE + b))
    return F.aggregate(ratios, F.lit(0.0), lambda acc, x: acc + x) / n


def uncovered(run: Column, base: Column) -> Column:
    """The stretches of a run of LEAST_RUN characters or more between the (sorted) base spans."""

    def add(out, a, b):
        return F.when(b - a >= LEAST_RUN, F.concat(out, F.array(F.struct(a.alias("start"), b.alias("end"), F.lit(MARKOV).alias("kind"))))).otherwise(out)

    def step(acc, b):
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), add(acc["out"], acc["at"], b["start"]).alias("out"))

    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    begin = F.struct(run["start"].alias("at"), none().alias("out"))
    return F.aggregate(over, begin, step, lambda acc: add(acc["out"], acc["at"], run["end"]))


def scan_secrets(docs: DataFrame, table: list[float]) -> DataFrame:
    """``docs`` with base (spans by pattern) and spans (these, and those that the models add; sorted by start, then kind)."""
    base, spans = fresh(docs, "base", "spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    ratios = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    runs = F.when(text.rlike(RUN), spans_of(text, MARKOV, RUN, 0, 1)).otherwise(none())
    fresh_runs = F.flatten(F.transform(runs, lambda s: uncovered(s, F.col(base))))
    random = F.filter(fresh_runs, lambda s: markov_score(F.substring(text, s["start"] + 1, s["end"] - s["start"]), ratios) >= LEAST_RATIO)
    order = F.create_map(*[F.lit(x) for k, kind in enumerate([*[b[0] for b in BASE], MARKOV]) for x in (kind, k)])
    ordered = lambda x: F.transform(F.array_sort(F.transform(x, lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("nth"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    out = docs.withColumn(base, ordered(base_spans(text)))
    return out.withColumn(spans, F.when((F.size(F.col(base)) > 0) | text.rlike(RUN), ordered(F.concat(F.col(base), random))).otherwise(F.col(base)))


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch of (possibly overlapping) sorted spans replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, train(labelled_samples(spark, docs)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(b[0]) for b in BASE], F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: s["kind"] == MARKOV)).cast("long").alias("n_markov"))
