"""Entity resolution.

Every merge needs an equal domain, or an equal phone with a like name and an equal zip, and every veto an equal domain or phone. So
connected components of equal domains and phones are independent of each other, and the order-dependent merging runs inside each.
Components are found over the distinct pairs of a domain and a phone, not over records. A component's records then stream through
a task in their order: only entities are held, by domain and by phone, and each record leaves with the entity that it
joined. A component of any size costs the memory of its entities; its time stays one task's, as each record depends on those before.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.similarity import EARTH_KM, common_length, resolver_key, sorted_tokens
from leadloom.functions.text import name_resolver, phone_resolver
from leadloom.functions.urls import domain_resolver
from leadloom.operators.components import components
from leadloom.sources.scratch import materialize

MERGE_SCORE, NAME_LIKENESS, DOMAIN_NAME_LIKENESS, PHONE_KM = 65, 85, 60, 5.0
#: Records of a block, when all pairs of a key are made.
BLOCK_ROWS = 1_000
#: Pairs whose records are prepared together, and those scored at a time.
PAIRS, SLICE = 1 << 18, 1 << 15


def prepared(records: DataFrame) -> DataFrame:
    """Adds ``name``, ``phone`` and ``domain`` as the resolver compares them."""
    return records.withColumns(
        {"name": name_resolver(F.col("raw_company_name")), "phone": phone_resolver(F.col("raw_phone")), "domain": domain_resolver(F.col("raw_website"))}
    )


def _tiles(p: DataFrame, key: str) -> DataFrame:
    """Records with an equal ``key`` (columns kind, key, i, j, side and theirs), each in every tile of its block. Records of a key lie in blocks of about BLOCK_ROWS, and
    every two blocks (sides 0 and 1), or a block alone, are a tile, so that a hot key's pairs are many tasks' work and none holds more than two blocks."""
    sizes = p.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key, F.ceil(F.col("_n") / BLOCK_ROWS).alias("_blocks"))
    rows = p.join(sizes, key).withColumn("_block", F.pmod(F.xxhash64("ord"), F.col("_blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
    tile = [F.lit(key).alias("kind"), F.col(key).alias("key"), F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"), (F.col("_block") > F.col("_other")).cast("int").alias("side")]
    return rows.select(*tile, *_PAIRED)


_PAIRED = ("ord", "words", "named", "phone", "domain", "mailing_zip", "lat", "lng")


@lru_cache(maxsize=100_000)
def _half_up(x: float, digits: int) -> float:
    """``x`` rounded as Spark's round does: its shortest decimal form, halves away from zero."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def _numbered(codes):
    """The distinct values of an array of small numbers, and for each number the place of its value: np.unique without a sort."""
    import numpy as np

    seen = np.bincount(codes) > 0
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]


class Common:
    """Lengths of the longest common subsequences of words: ``common_length`` of many pairs at a time, a machine word of the one's letters in each.

    ``n`` pairs are going to be asked for: where the words are few beside them, all are compared at once and looked up."""

    def __init__(self, words: list[str], n: int):
        import numpy as np

        self.words, self.sizes = words, np.array([len(w) for w in words])
        width = max(1, int(self.sizes.max(initial=0)))
        letter = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
        given = np.arange(width) < self.sizes[:, None]
        alphabet, code = np.unique(letter[given], return_inverse=True)
        self.code = np.zeros(letter.shape, np.int32)  # 0 is no letter
        self.code[given] = code + 1
        self.places, every = np.zeros((len(alphabet) + 1, len(words)), np.uint64), np.arange(len(words))
        for at in range(min(width, 64)):
            self.places[self.code[:, at], every] |= np.uint64(1 << at)
        self.places[0] = 0
        self.ones = np.array([(1 << min(len(w), 64)) - 1 for w in words], np.uint64)
        self.long = bool((self.sizes > 64).any())
        self.table = None
        if words and not self.long and len(words) ** 2 <= n:
            step = max(1, 32_768 // len(words))
            wide = lambda c: self._compared(np.broadcast_to(self.ones, (len(c), len(words))), (self.places[c[:, at]] for at in range(c.shape[1])), self.ones)
            self.table = np.concatenate([wide(self.code[k : k + step]) for k in range(0, len(words), step)])

    @staticmethod
    def _compared(state, hits, ones):
        import numpy as np

        for hit in hits:
            hit = hit & state
            state = state + hit | state - hit
        return np.bitwise_count(~state & ones).astype(np.int32)

    def of(self, x, y):
        """For arrays of places among the words."""
        import numpy as np

        if self.table is not None:
            return self.table[x, y]
        if not self.long:
            longest = int(self.sizes[y].max(initial=0))
            return self._compared(self.ones[x], (self.places[self.code[y, at], x] for at in range(longest)), self.ones[x])
        out = np.zeros(len(x), np.int32)
        x, y = np.where(self.sizes[x] > 64, y, x), np.where(self.sizes[x] > 64, x, y)
        for k in np.flatnonzero(self.sizes[x] > 64).tolist():
            out[k] = common_length(self.words[x[k]], self.words[y[k]])
        short = np.flatnonzero(self.sizes[x] <= 64)
        x, y = x[short], y[short]
        longest = int(self.sizes[y].max(initial=0))
        out[short] = self._compared(self.ones[x], (self.places[self.code[y, at], x] for at in range(longest)), self.ones[x])
        return out


def _scored(rows, tiles, digits: int | None, km: bool):
    """The scores of all pairs of ``tiles``, slices of ``rows`` (start, start of side 1, end), SLICE pairs or one row's at a time."""
    import numpy as np
    import pyarrow as pa

    lo, hi = tiles[0][0], tiles[-1][2]
    rows = rows.slice(lo, hi - lo)
    first, n = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)  # of each row, those that it meets
    for start, other, end in tiles:
        own = slice(start - lo, other - lo)
        first[own] = np.arange(start, other) + 1 - lo if other == end else other - lo
        n[own] = end - lo - first[own]

    def code(name):
        found = rows.column(name).combine_chunks().dictionary_encode()
        return found.indices.fill_null(-1).to_numpy(zero_copy_only=False), found.dictionary.to_pylist()

    def cells(name):
        return rows.column(name).to_numpy()

    order, (domain, _), (phone, _) = cells("ord"), code("domain"), code("phone")
    by_phone = cells("kind") == "phone"
    (words, texts), (zips, zip_texts), named = code("words"), code("mailing_zip"), cells("named").astype(bool)
    zips = np.where(np.array([z == "" for z in zip_texts] + [True])[zips], -1, zips)  # an empty zip is like none
    ends = np.cumsum(n)
    sizes, like = np.array([len(t) for t in texts] + [0]), Common(texts, int(ends[-1]))
    lat, lng = np.radians(cells("lat")), np.radians(cells("lng"))
    cos, placed = np.cos(lat), np.logical_and(*(rows.column(c).is_valid().to_numpy() for c in ("lat", "lng")))
    limit = math.sin(PHONE_KM / 2 / EARTH_KM) ** 2
    points = np.array([sum(v for k, v in enumerate((10, 30, 35, 30)) if bits >> k & 1) for bits in range(16)], np.int32)
    any_of = {"phone": by_phone.any(), "words": (words < 0).any()}

    def part(x, y):
        def same(codes):
            a = codes[x]
            return (a == codes[y]) & (a >= 0)

        same_domain, same_phone, a, b = same(domain), same(phone), order[x], order[y]
        kept = a != b
        if any_of["phone"]:
            kept &= ~(by_phone[x] & same_domain)
        if not kept.all():
            x, y, a, b, same_domain, same_phone = (v[kept] for v in (x, y, a, b, same_domain, same_phone))
        u, v = words[x], words[y]
        known = (u >= 0) & (v >= 0) if any_of["words"] else np.ones(len(x), bool)
        ratio, unlike = np.full(len(x), 100.0), np.flatnonzero((u != v) & known)
        if len(unlike):
            u, v = u[unlike], v[unlike]
            common, total = like.of(v, u), sizes[u] + sizes[v]  # u comes in runs
            width = int(total.max()) + 1
            seen, at = np.unique(common * width + total, return_inverse=True) if width > 256 else _numbered(common * width + total)
            values = [200.0 * (k // width) / (k % width) for k in seen.tolist()]
            plain = np.array(values)[at]
            ratio[unlike] = plain if digits is None else np.array([_half_up(k, digits) for k in values])[at]
        both = named[x] & named[y] & known
        alike, apart = both.copy(), np.zeros(len(x), bool)  # by the likeness before it is rounded
        if len(unlike):
            alike[unlike] &= plain >= NAME_LIKENESS
            apart[unlike] = both[unlike] & (plain < DOMAIN_NAME_LIKENESS)
        veto = same_domain & apart
        ask = np.arange(len(x)) if km else np.flatnonzero(same_phone & placed[x] & placed[y])
        p, q = x[ask], y[ask]
        h = np.sin((lat[q] - lat[p]) / 2) ** 2 + cos[p] * cos[q] * np.sin((lng[q] - lng[p]) / 2) ** 2
        close, located = h <= limit, placed[p] & placed[q]
        exact = np.arange(len(h)) if km else np.flatnonzero(np.abs(h - limit) < 1e-9 * limit)  # else the arc is needed only where it decides
        with np.errstate(invalid="ignore"):
            away = 2 * EARTH_KM * np.arcsin(np.sqrt(h[exact]))
        close[exact] = away <= PHONE_KM
        veto[ask] |= same_phone[ask] & located & ~close  # as in SQL, what is no number is far
        bits = same(zips).view(np.uint8) | alike.view(np.uint8) << 1 | same_domain.view(np.uint8) << 2 | same_phone.view(np.uint8) << 3
        made = {"a_ord": pa.array(np.minimum(a, b)), "b_ord": pa.array(np.maximum(a, b)), "name_score": pa.array(ratio, mask=None if known.all() else ~known)}
        made |= {"km": pa.array(away, mask=~located)} if km else {}
        return pa.RecordBatch.from_pydict(made | {"veto": pa.array(veto), "score": pa.array(points[bits])})

    at = 0
    while at < hi - lo:
        before = int(ends[at] - n[at])
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        if int(ends[to - 1]) > before:
            x = np.repeat(np.arange(at, to), n[at:to])
            yield part(x, np.arange(len(x)) + np.repeat(first[at:to] - ends[at:to] + n[at:to] + before, n[at:to]))
        at = to


def _pairs_of(batches, digits: int | None, km: bool):
    """Rows of tiles, in their order, to pairs; held are the records of a batch and SLICE pairs."""
    import numpy as np
    import pyarrow as pa

    def scored(rows, starts, ends):
        side = rows.column("side").to_numpy()
        waiting, n = [], 0
        for start, end in zip(starts, ends):
            other = start + int(np.searchsorted(side[start:end], 1))
            if 0 < other - start < end - start or other == end > start + 1:
                waiting.append((start, other, end))
                n += (other - start) * (end - other) or (end - start) ** 2 // 2
            if n >= PAIRS:
                yield from _scored(rows, waiting, digits, km)
                waiting, n = [], 0
        if waiting:
            yield from _scored(rows, waiting, digits, km)

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        if not rows.num_rows:
            continue
        new = np.zeros(rows.num_rows, bool)
        for name in ("kind", "key", "i", "j"):
            codes = rows.column(name).combine_chunks().dictionary_encode().indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        yield from scored(rows, starts[:-1], starts[1:])
        held = rows.slice(starts[-1])
    if held is not None:
        yield from scored(held.combine_chunks(), [0], [held.num_rows])


def candidate_pairs(records: DataFrame, digits: int | None = None, km: bool = True) -> DataFrame:
    """Scores of all pairs of records (``ord`` of a before b) with an equal domain or phone: parts, veto and total.

    For looking at the evidence; resolution itself never makes pairs. Names are put in order once a record, and those that then differ are compared
    many at a time; ``digits`` rounds name_score, and without ``km`` distances are taken only where they can veto and left out."""
    p = prepared(records).withColumn("words", sorted_tokens(F.col("name"))).withColumn("named", F.coalesce(F.col("name") != "", F.lit(False)))
    kind = p.schema["ord"].dataType
    p = p.withColumns({"ord": F.col("ord").cast("bigint"), "lat": F.col("lat").try_cast("double"), "lng": F.col("lng").try_cast("double"), "mailing_zip": F.col("mailing_zip").cast("string")})
    p = materialize(p.select(*_PAIRED), "paired-records")
    n = 8 * p.sparkSession.sparkContext.defaultParallelism
    tiles = _tiles(p, "domain").unionByName(_tiles(p, "phone")).repartition(n, "kind", "key", "i", "j").sortWithinPartitions("kind", "key", "i", "j", "side")
    pairs = tiles.mapInArrow(lambda batches: _pairs_of(batches, digits, km), f"a_ord bigint, b_ord bigint, name_score double, {'km double, ' * km}veto boolean, score int")
    return pairs.withColumns({c: F.col(c).cast(kind) for c in ("a_ord", "b_ord")})


def component_of(records: DataFrame) -> DataFrame:
    """``ord`` and ``component`` of prepared records: linked through equal domains and phones, by way of the values rather than by pairs.

    A component is named by a hash of one of its values; a record without any by its own ord, which is not negative."""
    values = records.select("ord", _value("d", "domain").alias("d"), _value("p", "phone").alias("p"))
    edges = values.where("d IS NOT NULL AND p IS NOT NULL").select(F.col("d").alias("a"), F.col("p").alias("b")).distinct()
    found = components(materialize(edges, "value-links")).select(F.col("node").alias("value"), "root")
    mine = values.select("ord", F.coalesce("d", "p").alias("value"))
    return mine.join(found, "value", "left").select("ord", F.coalesce("root", "value", "ord").alias("component"))


def _value(kind: str, column: str):
    """A negative number for a domain or phone; if two should share it, their components are resolved together, with the same result."""
    return F.when(F.col(column) != "", -1 - F.xxhash64(F.lit(kind), F.col(column)).bitwiseAND(F.lit((1 << 63) - 1)))


def _ratio(a: str, b: str) -> float:
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200.0 * common_length(x, y) / (len(x) + len(y)) if x or y else 100.0


def _km(a: dict, b: dict) -> float | None:
    try:
        lat1, lng1, lat2, lng2 = (math.radians(float(v)) for v in (a["lat"], a["lng"], b["lat"], b["lng"]))
    except (TypeError, ValueError):
        return None
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lng2 - lng1) / 2) ** 2
    return 2 * EARTH_KM * math.asin(math.sqrt(h))


def match(record: dict, entity: dict) -> tuple[int, list[str]] | None:
    """(score, reasons) of a record against an entity, by the entity's founding name; None for a veto."""
    score, why = 0, []
    both = record["name"] and entity["name"]
    likeness = _ratio(record["name"], entity["name"]) if both else None
    if both and likeness >= NAME_LIKENESS:
        score += 30
        why.append(f"name similarity {likeness}%")
    if record["domain"] and record["domain"] == entity["domain"]:
        if both and likeness < DOMAIN_NAME_LIKENESS:
            return None
        score += 35
        why.append("exact domain match")
    if record["phone"] and record["phone"] == entity["phone"]:
        km = _km(record, entity)
        if km is not None and km > PHONE_KM:
            return None
        score += 30
        why.append("phone match")
    if record["mailing_zip"] and record["mailing_zip"] == entity["mailing_zip"]:
        score += 10
        why.append("ZIP match")
    return score, why


def merge_in_order(records: list[dict]) -> list[dict]:
    """Entities of one component: each record joins the best entity so far, unless any comparison vetoes, or founds one."""
    entities: list[dict] = []
    for r in records:
        best, score, why = None, 0, []
        for e in entities:
            found = match(r, e)
            if found is None:
                best = None
                break
            if found[0] > score:
                best, (score, why) = e, found
        if best is not None and score >= MERGE_SCORE:
            best["members"].append(r["ord"])
            best["confidence"], best["why"] = score, why
            if r["name"] and r["name"] not in best["aliases"]:
                best["aliases"].append(r["name"])
            best["phone"] = best["phone"] or r["phone"]
            best["domain"] = best["domain"] or r["domain"]
        else:
            raw = r["raw_company_name"]
            entities.append(r | {"members": [r["ord"]], "aliases": [raw] if raw else [], "confidence": 100, "why": ["initial entity"], "founding_domain": r["domain"]})
    return entities


class Entities:
    """The entities of a component as its records come in, found by domain and by phone.

    Gives what ``merge_in_order`` gives. An entity without the record's domain and phone can neither veto nor reach MERGE_SCORE, and a veto by any entity
    decides whatever its place; so only those of the domain and the phone are asked, names once for each pair of
    distinct names, and first the one that vetoed last.
    """

    def __init__(self):
        self.all: list[dict] = []
        self.of_domain: dict[str, list[dict]] = {}
        self.of_phone: dict[str, list[dict]] = {}
        self.names: dict[str, dict[str, None]] = {}
        self.asked: dict[tuple[str, str], tuple[int, bool]] = {}
        self.likeness: dict[tuple[str, str], float] = {}
        self.far: dict[str, dict] = {}

    def like(self, a: str, b: str) -> float:
        key = (a, b) if a < b else (b, a)
        if key not in self.likeness:
            if len(self.likeness) > 1_000_000:
                self.likeness.clear()
            self.likeness[key] = _ratio(*key)
        return self.likeness[key]

    def name_conflict(self, domain: str, name: str) -> bool:
        """Whether an entity of ``domain`` has a name unlike ``name``; each pair of names is compared once."""
        names = self.names.get(domain, {})
        upto, bad = self.asked.get((domain, name), (0, False))
        if not bad and upto < len(names):
            bad = any(self.like(name, other) < DOMAIN_NAME_LIKENESS for other in list(names)[upto:])
            self.asked[domain, name] = (len(names), bad)
        return bad

    def too_far(self, record: dict) -> bool:
        """Whether an entity with the record's phone is too far away."""
        last = self.far.get(record["phone"])
        here = lambda e: (km := _km(record, e)) is not None and km > PHONE_KM
        if last is not None and here(last):
            return True
        for e in self.of_phone.get(record["phone"], ()):
            if here(e):
                self.far[record["phone"]] = e
                return True
        return False

    def add(self, record: dict) -> dict:
        """The entity that ``record`` joins or founds."""
        name, domain, phone = record["name"], record["domain"], record["phone"]
        best, score, why = None, 0, []
        if not ((domain and name and self.name_conflict(domain, name)) or (phone and self.too_far(record))):
            near = {e["no"]: e for e in (*self.of_domain.get(domain, ()), *self.of_phone.get(phone, ()))} if domain or phone else {}
            for no in sorted(near):
                got = self._score(record, near[no])
                if got[0] > score:
                    best, (score, why) = near[no], got
        if best is None or score < MERGE_SCORE:
            raw = record["raw_company_name"]
            best = record | {"no": len(self.all), "founder": record["ord"], "aliases": {raw: None} if raw else {}, "founding_domain": domain}
            self.all.append(best)
            self._index(best, domain, phone)
            score, why = 100, ["initial entity"]
        else:
            if name:
                best["aliases"].setdefault(name)
            fresh_domain, fresh_phone = domain if not best["domain"] else None, phone if not best["phone"] else None
            best["domain"], best["phone"] = best["domain"] or domain, best["phone"] or phone
            self._index(best, fresh_domain, fresh_phone)
        best["confidence"], best["why"] = score, why
        return best

    def _index(self, entity: dict, domain: str | None, phone: str | None) -> None:
        if domain:
            self.of_domain.setdefault(domain, []).append(entity)
            if entity["name"]:
                self.names.setdefault(domain, {}).setdefault(entity["name"])
        if phone:
            self.of_phone.setdefault(phone, []).append(entity)

    def _score(self, record: dict, entity: dict) -> tuple[int, list[str]]:
        """As ``match``, for an entity that does not veto."""
        score, why = 0, []
        if record["name"] and entity["name"] and (likeness := self.like(record["name"], entity["name"])) >= NAME_LIKENESS:
            score += 30
            why.append(f"name similarity {likeness}%")
        for field, points, reason in (("domain", 35, "exact domain match"), ("phone", 30, "phone match"), ("mailing_zip", 10, "ZIP match")):
            if record[field] and record[field] == entity[field]:
                score += points
                why.append(reason)
        return score, why


_INPUT = ("ord", "raw_company_name", "name", "phone", "domain", "mailing_street", "mailing_city", "mailing_state", "mailing_zip", "lat", "lng")
_ENTITY = (
    "canonical_name string, alias_names array<string>, phone_primary string, website string, founding_domain string, mailing_street string, mailing_city string, "
    "mailing_state string, mailing_zip string, lat double, lng double, merge_confidence int, merge_explanation array<string>"
)


def _cells(column) -> list:
    """The values of an Arrow column, nulls as None; through numpy where that keeps them."""
    import pyarrow as pa

    plain = not column.null_count or pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    return column.to_numpy(zero_copy_only=False).tolist() if plain else column.to_pylist()


def _stream(batches):
    """Rows (component and _INPUT, by component and ord) to founder and ord of each record, and one row without ord for each entity."""
    import pyarrow as pa

    text, texts = pa.string(), pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), text, texts, *[text] * 7, pa.float64(), pa.float64(), pa.int32(), texts]
    names = ["founder", "ord", *[f.strip().split(" ")[0] for f in _ENTITY.split(", ")]]

    def made(entities: list[dict]):
        rows = []
        for e in entities:
            own = [e[c] for c in ("founding_domain", "mailing_street", "mailing_city", "mailing_state", "mailing_zip", "lat", "lng")]
            rows.append((e["founder"], None, e["raw_company_name"], list(e["aliases"]), e["phone"], e["domain"], *own, e["confidence"], e["why"]))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 15, kinds)], names=names)

    def members(founders: list[int], ords):
        return pa.RecordBatch.from_arrays([pa.array(founders, kinds[0]), ords, *[pa.nulls(len(founders), k) for k in kinds[2:]]], names=names)

    component, held = None, Entities()
    for batch in batches:
        founders = []
        # A column at a time: values of single cells and rows are dear, and one task may have most of the records.
        for of, *row in zip(*[_cells(batch.column(c)) for c in ("component", *_INPUT)]):
            if of != component:
                for at in range(0, len(held.all), 10_000):
                    yield made(held.all[at : at + 10_000])
                component, held = of, Entities()
            founders.append(held.add(dict(zip(_INPUT, row)))["founder"])
        yield members(founders, batch.column("ord").cast(kinds[1]))
    for at in range(0, len(held.all), 10_000):
        yield made(held.all[at : at + 10_000])


def resolve_entities(records: DataFrame) -> DataFrame:
    """Entities of normalised records (raw_company_name, raw_phone, raw_website, mailing fields, lat, lng, ``ord``: not negative, each once): one
    row each, with the members' ords. The id is a hash of the founder's ord."""
    p = prepared(records).withColumns({c: F.col(c).cast("double") for c in ("lat", "lng")})
    p = materialize(p.select(*_INPUT), "resolver-records")
    ordered = p.join(component_of(p), "ord").select("component", *_INPUT).repartition("component").sortWithinPartitions("component", "ord")
    found = materialize(ordered.mapInArrow(_stream, f"founder bigint, ord bigint, {_ENTITY}"), "resolved")
    members = found.where("ord IS NOT NULL").groupBy("founder").agg(F.array_sort(F.collect_list("ord")).alias("record_ords"))
    entities = found.where("ord IS NULL").drop("ord").join(members, "founder").withColumn("business_id", F.md5(F.col("founder").cast("string")))
    key = resolver_key(F.col("founding_domain"), F.lit(None).cast("string"), F.col("canonical_name"), F.col("mailing_street"), F.col("mailing_zip"))
    names = "business_id canonical_name alias_names phone_primary website mailing_street mailing_city mailing_state mailing_zip lat lng record_ords merge_confidence merge_explanation".split()
    return entities.select(*names, key.alias("dedupe_key"))
