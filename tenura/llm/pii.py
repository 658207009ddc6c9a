"""Personal data with information-theoretic sanitisation (operator 9).

E-mail addresses, IP addresses, card and phone numbers are the protected entities. A term in a text with an entity discloses it as
far as knowing the term makes the entity likely: with ``IC(e) = log(N / n(e))`` and the pointwise mutual information
``PMI(t, e) = log(N * n(t, e) / (n(t) * n(e)))``, the term gives away the share ``PMI / IC`` of what the entity hides.
``N`` and ``n`` count texts of the whole corpus, ``n(t, e)`` those that hold both, however far apart. Terms whose share
reaches ``disclosure``, met together with the entity in ``support`` texts or more, are generalised at all their places in the
texts that hold the entity; other texts stay as they are.

One pass finds entities, another counts the texts of each term (summed inside each task before it is shuffled). Entities of
fewer than ``support`` texts cannot be disclosed, nor can any entity by a term of more texts than ``n(e) * (N / n(e)) ** (1 -
disclosure)``; a third pass gives the terms left, with their places, of the texts that hold an entity left. Equal texts are
followed once, with their number, and so are entities of the same texts. Texts are never shuffled, and lists are only
gathered for one text at a time.

Edge cases: a null or empty text has no spans; ids may be null or repeated, each row gets its own result; other columns are
ignored by :func:`find_personal_data` and kept by :func:`redact`. An empty table gives an empty result. Positions count
code points, ends are exclusive. Spans of different kinds may overlap; redaction takes the first to begin, and among
those the kind listed first.
"""

from __future__ import annotations

import copy
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bitmap
from tenura.llm.arrow import keep_rows, map_batches, text_column, unused
from tenura.llm.words import chunks, mix
from tenura.session import materialize

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 2
DISCLOSURE = 0.9

# The patterns of the four kinds.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]")

_TELLING = np.zeros(256, dtype=bool)
_TELLING[[ord("@"), *range(48, 58)]] = True


def _emails(text: str):
    """Around each at sign: the run of local signs before it, back to the last match, and a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_SIGNS:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            yield begin, match.end()
        # Signs before this at sign cannot begin a later match.
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _ip(found: str) -> bool:
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in (p.lstrip("0") for p in found.split(".")))


def _card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 16 <= len(digits) <= 19 and _luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the entities in a text, by kind and start."""
    spans = [("email", *span) for span in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if _ip(m.group())]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if _card(m.group())]
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return spans


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8"), digest_size=8).digest(), "big", signed=True)


def _free(text: str, spans) -> list[tuple[int, int, bool]]:
    """Start and end of each word of a text, and whether it overlaps no entity."""
    places = [m.span() for m in _WORD.finditer(text)]
    starts, ends = np.array([p[0] for p in places]), np.array([p[1] for p in places])
    free = np.ones(len(places), dtype=bool)
    for _, start, end in spans:
        free[int(np.searchsorted(ends, start, side="right")) : int(np.searchsorted(starts, end))] = False
    return [(*place, own) for place, own in zip(places, free)]


def _telling(column) -> np.ndarray:
    """Texts with an at sign or a digit; no others hold an entity."""
    return np.concatenate([c.sums(_TELLING[c.data]) > 0 for c in chunks(column)] or [np.zeros(0, dtype=bool)])


def _scan(column) -> list[list[tuple[str, int, int]]]:
    """Base spans of each text of a column."""
    spans = []
    for value, flagged in zip(column, _telling(column)):
        text = value.as_py() if flagged else None
        spans.append(base_spans(text) if text else [])
    return spans


def term_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Number of texts that hold each ``term`` (the hash of a lower-cased word), over all texts."""

    def run(batch):
        terms = []
        for chunk in chunks(text_column(batch, "_text")):
            hashes = chunk.word_hashes()
            _, first = np.unique(mix(hashes) ^ mix(chunk.owner().astype(np.uint64)), return_index=True)
            terms.append(hashes[first])
        found, counts = np.unique(np.concatenate(terms or [np.zeros(0, np.uint64)]), return_counts=True)
        return {"term": found.view(np.int64), "n_term": counts}

    rows = map_batches(df.select(df[text_col].cast("string").alias("_text")), run, "term long, n_term long")
    return rows.groupBy("term").agg(F.sum("n_term").alias("n_term"))


def _disclosable(scanned: DataFrame, n_texts: int, support: int) -> DataFrame:
    """Distinct texts with entities that terms can disclose: ``_text_key``, rows ``m``, ``entities``, ``n_entity``.

    ``entities`` stands for all entities of the same texts, as terms disclose either all of them or none.
    """
    texts = scanned.where(F.size("_entities") > 0).groupBy("_text_key").agg(
        F.count(F.lit(1)).alias("m"), F.first("_entities").alias("_entities")
    )
    pairs = texts.select("_text_key", "m", F.explode("_entities").alias("entity"))
    each = pairs.groupBy("entity").agg(
        F.sum("m").alias("n_entity"),
        F.sum(F.xxhash64("_text_key") % (1 << 40)).alias("_s"), F.bit_xor(F.xxhash64("_text_key")).alias("_x"),
    )
    each = each.where((F.col("n_entity") >= support) & (F.col("n_entity") < n_texts))
    named = each.select("entity", "n_entity", F.xxhash64("n_entity", "_s", "_x").alias("entities"))
    return materialize(pairs.join(named, "entity").drop("entity").distinct(), "pii-texts")


_PLACES = "array<struct<start:int,end:int>>"


def _term_places(df: DataFrame, text_col: str, texts, terms) -> DataFrame:
    """Every free place of the wanted terms in the wanted texts: ``_text_key``, ``term``, ``_places``.

    ``texts`` and ``terms`` are broadcast bitmaps.
    """

    def run(batch):
        column, out, done = text_column(batch, "_text"), {c: [] for c in ("_text_key", "term", "_places")}, set()
        for chunk in chunks(column):
            hashes = chunk.word_hashes()
            for i in np.flatnonzero(chunk.sums(_TELLING[chunk.data]) > 0):
                text = column[chunk.first + int(i)].as_py()
                key = _key(text)
                if key in done or not bitmap.holds(texts.value, np.array([key], dtype=np.int64))[0]:
                    continue
                done.add(key)
                own = hashes[chunk.word_edges[i] : chunk.word_edges[i + 1]]
                wanted, held = bitmap.holds(terms.value, own), {}
                for term, able, (start, end, free) in zip(own.view(np.int64).tolist(), wanted, _free(text, base_spans(text))):
                    if able and free:
                        held.setdefault(term, []).append({"start": start, "end": end})
                out["_text_key"] += [key] * len(held)
                out["term"] += held
                out["_places"] += held.values()
        return out

    source = df.select(df[text_col].cast("string").alias("_text"))
    rows = map_batches(source, run, f"_text_key long, term long, _places {_PLACES}")
    return rows.groupBy("_text_key", "term").agg(F.first("_places").alias("_places"))


def _most(n_texts: int, disclosure: float):
    """The most texts that a term can have to disclose an entity, a little more for rounding."""
    n = F.col("n_entity")
    return (1 + 1e-9) * n * F.pow(F.lit(float(n_texts)) / n, F.lit(1.0 - disclosure))


def _scanned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One stored row per text: id, key of the text, counts, base spans and entities."""
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"{id_col} {kind}, {counted}, _base string, _entities array<long>, _text_key long"

    def run(batch):
        column = text_column(batch, "_text")
        spans = _scan(column)
        out = {id_col: text_column(batch, "_id"), "_base": [joined(s) for s in spans]}
        out["_entities"], out["_text_key"] = [], []
        for i, found in enumerate(spans):
            text = column[i].as_py() if found else ""
            out["_entities"].append(sorted({_key(f"{k}:{text[a:b]}") for k, a, b in found}))
            out["_text_key"].append(_key(text) if found else 0)
        for k in KINDS:
            out[f"n_{k}"] = [sum(s[0] == k for s in found) for found in spans]
        return out

    return materialize(map_batches(source, run, schema), "pii-scan")


def _terms(df: DataFrame, scanned: DataFrame, text_col: str, support: int, disclosure: float) -> DataFrame:
    """``_text_key`` and ``_terms``, the places of disclosing terms by start, of the distinct texts that have any."""
    n_texts = scanned.count()
    texts = _disclosable(scanned, n_texts, support)
    most = texts.agg(F.max(_most(n_texts, disclosure))).first()[0] or 0.0
    counts = term_counts(df, text_col).where((F.col("n_term") >= support) & (F.col("n_term") <= most))
    counts = materialize(counts, "pii-counts")
    context = df.sparkSession.sparkContext
    wanted = (bitmap.build(texts.select("_text_key").distinct(), "_text_key"), bitmap.build(counts, "term"))
    places = _term_places(df, text_col, *(context.broadcast(b) for b in wanted)).join(counts, "term")
    places = materialize(places, "pii-terms")
    able = F.col("n_term") <= _most(n_texts, disclosure)
    met = places.join(texts, "_text_key").where(able)
    joint = met.groupBy("entities", "n_entity", "term", "n_term").agg(F.sum("m").alias("n_both"))
    share = 1 + F.log(F.col("n_both") / F.col("n_term")) / F.log(F.lit(float(n_texts)) / F.col("n_entity"))
    pairs = joint.where((F.col("n_both") >= support) & (share >= disclosure)).select("entities", "term")
    return (
        met.join(pairs, ["entities", "term"], "left_semi")
        .groupBy("_text_key")
        .agg(F.sort_array(F.flatten(F.collect_set("_places"))).alias("_terms"))
    )


def _spans(df: DataFrame, id_col: str, text_col: str, support: int, disclosure: float) -> DataFrame:
    """The scanned rows with the spans of disclosing terms, ordered by start, in ``_terms``."""
    scanned = _scanned(df, id_col, text_col)
    terms = _terms(df, scanned, text_col, support, disclosure)
    # Only texts with entities meet the terms; the others keep their place.
    with_terms = scanned.where(F.size("_entities") > 0).join(terms, "_text_key", "left")
    without = scanned.where(F.size("_entities") == 0)
    return with_terms.unionByName(without, allowMissingColumns=True)


def find_personal_data(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = SUPPORT,
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """Id, counts per kind, ``base`` spans and all ``spans`` of every text, as ``kind:start:end`` joined by commas."""
    rows = _spans(df, id_col, text_col, support, disclosure)
    added = F.transform("_terms", lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]))
    return rows.select(
        id_col,
        *[f"n_{k}" for k in KINDS],
        F.col("_base").alias("base"),
        F.when(F.size("_terms") > 0, F.concat_ws(",", "_base", F.array_join(added, ","))).otherwise(F.col("_base")).alias("spans"),
    )


def _replaced(text: str, terms) -> str:
    rank = {kind: i for i, kind in enumerate((*KINDS, TERM))}
    spans = base_spans(text) + [(TERM, t["start"], t["end"]) for t in terms or []]
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], rank[s[0]])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
            done = end
        elif end > done:  # what reaches beyond the span before it goes as well
            done = end
    return "".join([*out, text[done:]])


def redact(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = SUPPORT,
    disclosure: float = DISCLOSURE,
) -> DataFrame:
    """``df`` with entities and disclosing terms replaced by ``<kind>``; all other texts and columns unchanged.

    Only texts that can hold an entity are joined with the terms found for them.
    """
    terms = _terms(df, _scanned(df, id_col, text_col), text_col, support, disclosure)
    calm = keep_rows(df, lambda column: ~_telling(column), text_col)
    key, other, places = (unused(df, name) for name in ("_pii_key", "_text_key", "_pii_terms"))
    met = _keyed(df, text_col, key).join(terms.toDF(other, places), F.col(key) == F.col(other), "left")
    return calm.unionByName(_apply(met, df, text_col, key, places))


def _keyed(df: DataFrame, text_col: str, key: str) -> DataFrame:
    """The rows that may hold an entity, with the key of each text that does in the column ``key``."""
    schema = copy.deepcopy(df.schema).add(key, "long")

    def run(batch):
        batch = batch.filter(pa.array(_telling(text_column(batch, text_col)), type=pa.bool_()))
        out = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        texts = (v.as_py() for v in text_column(batch, text_col))
        out[key] = [_key(t) if t and base_spans(t) else None for t in texts]
        return out

    return map_batches(df, run, schema)


def _apply(met: DataFrame, df: DataFrame, text_col: str, key: str, places: str) -> DataFrame:
    names = df.columns

    def run(batch):
        out = {name: text_column(batch, name) for name in names}
        keys, terms = text_column(batch, key), text_column(batch, places)
        texts = [
            value.as_py() if not key.is_valid else _replaced(value.as_py(), term.as_py())
            for value, key, term in zip(out[text_col], keys, terms)
        ]
        out[text_col] = pa.array(texts, type=pa.string())
        return out

    return map_batches(met, run, df.schema)
