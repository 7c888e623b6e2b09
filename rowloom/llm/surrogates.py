"""Surrogates for personal data: keyed, of the same type and format, distinct for distinct entities, equal for equal ones.

Entities are found by pattern and brought to a canonical form (digits of a number, lower case of an address). A keyed hash of type,
form and attempt gives the surrogate: letters for letters, digits for digits, with the parts that carry meaning kept (country code,
key prefix, top-level domain, card issuer and check digit; gender and script of a name). All distinct entities of the corpus are
checked together: a surrogate that two entities share, or that is itself an entity of the corpus, goes to the next attempt; after a few
attempts surrogates grow longer, so that short forms can't run out. Texts are
then rewritten from the key alone; only texts that hold an entity beyond attempt 0 need its attempt, brought by a join.
"""

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import settled, text_chunks, text_key

# First names by script and gender, last names by script, titles by gender.
FIRST = {
    ("latin", "f"): "Anna Maria Laura Julia Sarah Emma Clara Elena Sofia Marie Paula Irene Nora Lena Carla Alice Helen Ruth Diana Lucia".split(),
    ("latin", "m"): "John Peter Thomas Michael David Paul Carlos Hans Pierre Jean Martin Felix Simon Oscar Bruno Victor Hugo Louis Karl Pablo".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Светлана Татьяна".split(),
    ("cyrillic", "m"): "Иван Петр Алексей Сергей Дмитрий Николай Андрей Михаил".split(),
}
LAST = {
    "latin": "Smith Miller Weber Garcia Martin Bernard Keller Lopez Moreau Fischer Baker Cooper Becker Romero Girard Walker Hoffmann Ortega Lambert Turner".split(),
    "cyrillic": "Иванов Петров Смирнов Волков Соколов Лебедев Козлов Новиков".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Mme": "f", "Monsieur": "m", "Madame": "f", "Sra": "f", "Señor": "m", "Señora": "f"}

#: Attempts after which a surrogate may be longer than its entity: short forms can run out.
LAST_OF_SAME_LENGTH = 4

_GENDER = {n: g for (_, g), names in FIRST.items() for n in names}
_CAP = r"[^\W\d_a-zà-ÿа-я][^\W\d_A-ZÀ-ÞА-Я]+"
_FOUND = re.compile(
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+\-]*@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,})"
    r"|(?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<hex>\b(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{32,64}\b)"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?:(?: ?\d{4}){3,7}(?: ?\d{1,3})?\b(?! ?[A-Z0-9]*\d)|(?=(?:[ A-Z]{0,6}\d){7})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b))"
    r"|(?P<card>(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d))"
    r"|(?P<phone>(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|(?<!\d)\d{2,4}[ .\-])\d{3,4}[ .\-]\d{3,4}(?!\d)|\+\d{9,14}(?!\d))"
    rf"|(?P<name>\b(?:(?:{'|'.join(TITLES)})\b\.? {_CAP}(?: {_CAP})?|(?:{'|'.join(_GENDER)}) {_CAP}))"
)
# a text without any of these has no entity
_MAYBE = re.compile(rf"[@\d]|\b(?:{'|'.join([*TITLES, *_GENDER])})\b")


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _canonical(kind: str, found: str) -> str:
    if kind in ("ssn", "card"):
        return re.sub(r"\D", "", found)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", found)
    if kind == "iban":
        return found.replace(" ", "")
    if kind == "name":
        words = found.split(" ")
        return _gender_of(found) + ":" + " ".join(w.capitalize() for w in words if w.rstrip(".") not in TITLES)
    return found.lower() if kind == "email" else found


class _Draws:
    """A stream of keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts):
        self.seed, self.n, self.key, self.pool = "\x1f".join(map(str, parts)).encode(), 0, key, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n


def _alike(text: str, draws: _Draws, digits: str = "0123456789", letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    out = []
    for c in text:
        if c.isdigit():
            out.append(digits[draws.below(len(digits))])
        elif c.isalpha():
            x = letters[draws.below(len(letters))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """The canonical surrogate of an entity's canonical form (a name's form starts with its gender, if known, and a colon)."""
    draws = _Draws(key, kind, form, attempt)
    extra = max(0, attempt - LAST_OF_SAME_LENGTH)
    if kind == "email":
        local, _, host = form.partition("@")
        labels = host.split(".")
        kept = 2 if labels[-2] == "example" else 1
        return _alike(local + "a" * extra, draws) + "@" + ".".join([*(_alike(x, draws) for x in labels[:-kept]), *labels[-kept:]])
    if kind == "key":
        return form[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draws.below(32)] for _ in form[4:])
    if kind == "hex":
        return "".join("0123456789abcdef"[draws.below(16)] for _ in form)
    if kind == "ip":
        return ".".join([str(1 + draws.below(223)), *(str(draws.below(256)) for _ in range(2)), str(1 + draws.below(254))])
    if kind == "card":
        body = form[0] + _alike(form[1:-1] + "0" * extra, draws)
        wanted = _luhn(form)
        return body + next(str(d) for d in range(10) if _luhn(body + str(d)) == wanted)
    if kind == "phone":
        kept = 2 if form.startswith("+1") else 3 if form.startswith("+") else 0
        rest = form[kept:] + "0" * extra
        return form[:kept] + str(2 + draws.below(8)) + _alike(rest[1:], draws)
    if kind == "iban":
        return form[:2] + _alike(form[2:] + "0" * extra, draws)
    if kind == "name":
        gender, _, name = form.partition(":")
        words = name.split(" ")
        script = "cyrillic" if re.search("[А-я]", form) else "latin"
        firsts = FIRST[script, gender] if gender else FIRST[script, "f"] + FIRST[script, "m"]
        out = [firsts[draws.below(len(firsts))]] if len(words) > 1 else []
        out.append(LAST[script][draws.below(len(LAST[script]))])
        return " ".join(out) + "".join("-" + LAST[script][draws.below(len(LAST[script]))] for _ in range(attempt))
    return _alike(form + "0" * extra, draws)


def _gender_of(found: str) -> str:
    words = [w.rstrip(".") for w in found.split(" ")]
    return TITLES.get(words[0]) or _GENDER.get(words[0], "")


def _laid_out(kind: str, found: str, new: str) -> str:
    """The surrogate in the spacing and case of the text it replaces."""
    if kind == "name":
        first = found.split(" ")[0]
        return f"{first} {new}" if first.rstrip(".") in TITLES else new
    if kind in ("ssn", "card", "phone", "iban"):
        fresh = iter(new)
        return "".join([next(fresh) if c.isalnum() or c == "+" else c for c in found]) + "".join(fresh)
    if kind == "email":
        local, _, host = found.partition("@")
        at = new.index("@")
        alike = lambda old, fresh: "".join(n.upper() if c.isupper() else n for c, n in zip(old.ljust(len(fresh)), fresh))
        return alike(local, new[:at]) + "@" + alike(host, new[at + 1 :])
    return new


def entities(text: str | None) -> list[tuple[str, str, str]]:
    """(kind, found, canonical form) of every entity of a text."""
    if not text or _MAYBE.search(text) is None:
        return []
    return [(m.lastgroup, m.group(), _canonical(m.lastgroup, m.group())) for m in _FOUND.finditer(text) if _holds(m)]


def _holds(m: re.Match) -> bool:
    """Long digit groups are card numbers only with a right check digit."""
    return m.lastgroup != "card" or _luhn(re.sub(r"\D", "", m.group())) == 0


def _mentions(docs: DataFrame, text: str) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                rows = [(i, k, f) for i, t in enumerate(texts) for k, f in {(k, f) for k, _, f in entities(t)}]
                own = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([own, *(pa.array([r[j] for r in rows], pa.string()) for j in (1, 2))], names=["text_key", "kind", "form"])

    return docs.select(text_key(text).alias("text_key"), F.col(text).alias("text")).mapInArrow(run, "text_key bigint, kind string, form string")


def _drawn(forms: DataFrame, key: bytes) -> DataFrame:
    def run(batches):
        for batch in batches:
            new = [surrogate(key, *x) for x in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "form", "attempt", "surrogate"])

    return forms.select("kind", "form", "attempt").mapInArrow(run, "kind string, form string, attempt int, surrogate string")


def assigned(mentions: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt, surrogate) of all distinct entities, no two with one surrogate, none with an entity's form."""
    forms = mentions.select("kind", "form").distinct()
    known = settled(_drawn(forms.withColumn("attempt", F.lit(0)), key), "surrogates")
    real = known.select("kind", F.regexp_replace("form", "^[mf]?:", "").alias("surrogate")).distinct().withColumn("real", F.lit(True))
    while True:
        owner = known.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "form")).alias("owner"))
        judged = known.join(owner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        judged = settled(judged.withColumn("clash", (F.col("owner.form") != F.col("form")) | F.coalesce("real", F.lit(False))).drop("owner", "real"), "judged")
        clashes = judged.filter("clash")
        if clashes.isEmpty():
            return known
        again = _drawn(clashes.withColumn("attempt", F.col("attempt") + 1), key)
        known = settled(judged.filter("not clash").select(*known.columns).union(again.select(*known.columns)), "surrogates")


def replace_entities(docs: DataFrame, key: bytes = b"rowloom", text: str = "text", count: str | None = None) -> DataFrame:
    """Every row with its text rewritten; `count` names a column for the number of replaced mentions.

    Null stays null, empty stays empty, texts without entities are unchanged. Equal texts are rewritten alike. Empty tables give
    empty results. Other columns pass through; a column named like `count` is replaced.
    """
    if count is not None and count != text:
        docs = docs.drop(count)
    names = docs.columns
    found = settled(_mentions(docs, text).distinct(), "mentions")
    later = assigned(found, key).filter("attempt > 0").select("kind", "form", "attempt")
    later = found.join(later, ["kind", "form"]).groupBy("text_key").agg(F.collect_list(F.struct("kind", "form", "attempt")).alias("_rowloom_later"))
    later = settled(later, "later-attempts").withColumnRenamed("text_key", "_rowloom_key")
    if later.isEmpty():
        rows = docs.withColumn("_rowloom_later", F.lit(None).cast("array<struct<kind:string,form:string,attempt:int>>"))
    else:
        rows = docs.withColumn("_rowloom_key", text_key(text)).join(later, "_rowloom_key", "left").select(*names, "_rowloom_later")
    schema = rows.select(*names, F.lit(0).cast("long").alias(count or "_rowloom_n")).schema
    at = names.index(text)

    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, text):
                late = batch.column(batch.num_columns - 1).to_pylist()
                new, n = [], []
                for t, extra in zip(texts, late):
                    mentions = entities(t)
                    n.append(len(mentions))
                    if mentions:
                        attempts = {(x["kind"], x["form"]): x["attempt"] for x in extra or ()}
                        fresh = iter(mentions)

                        def swap(m, fresh=fresh, attempts=attempts):
                            if not _holds(m):
                                return m.group()
                            kind, found, form = next(fresh)
                            return _laid_out(kind, found, surrogate(key, kind, form, attempts.get((kind, form), 0)))

                        t = _FOUND.sub(swap, t)
                    new.append(t)
                columns = list(batch.columns[:-1])
                columns[at] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=[*names, count or "_rowloom_n"])

    out = rows.mapInArrow(run, schema)
    return out if count is not None else out.drop("_rowloom_n")


@query("op5_surrogates")
def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs, count="n_replaced")
