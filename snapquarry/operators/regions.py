"""Regions of pages: cards and panes, and the records that are read off them.

Every operator parses its pages once (`dom.marked_nodes`) and deals the nodes by page; what stands in which card, pane, row or
box is known from the parse or from one sweep over a page in document order, so nothing is joined, and no other exchange
follows. A page goes as a whole to one task, as it does when it is parsed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import record_id
from ..functions.text import clean, extract_number
from .dom import marked_nodes, page_rows
from .records import locator, stable_key, tier_name

# How names of talents begin, and what the pages call their panes, sections, kinds of talents and sequences, levels and controls.
SIGNS = {"hyperlink|name|30001": "corrosion", "Func_Tips_DropSource": "drop_source"}
BASE_PANE, CRAFT_PANE, LEGENDARY_PANE = "基础词缀", "打造", "传奇品质"
TALENT_NAMES = {"传奇中型": "legendary_medium", "中型": "medium", "小型": "minor"}
SUPREME, POINTS = "至臻", r"^(?:(\d+)pts\s*)?(\d+)/(\d+)\s*"
RECIPES, SEQUENCES = "调香秘仪", "高塔序列"
TALENTS = {"中型天赋": "medium", "核心天赋": "core", "异香天赋": "exotic"}
SEQUENCE_TIERS = {"中阶序列": "intermediate", "高阶序列": "advanced"}
TRAIT_HEADER, REQUIRED_LEVEL, TRAIT_LEVEL, CONTROLS = r"^.+?\s*-\s*英雄特性\s*/\s*\d+$", r"需求等级\s*(\d+)", r"^等级\s*(\d+)$", ["展开", "收起", "查看"]
TAGS, SKILL_ID = "标签：", r"^\s*id:\s*(\S+)\s*$"
CONTRACTS = "契约效果"
_PANE_ID = re.compile(r"\|(.*)$")


# ---- marks: null where an element isn't marked


def card(tag, attrs, classes):
    """The kind of a card as far as its own classes tell it."""
    if "popupItem" in classes:
        return "historical" if "previousItem" in classes else "current"
    return "other" if tag == "div" and "card" in classes else None


def popup(tag, attrs, classes):
    return ("historical" if "previousItem" in classes else "current") if "popupItem" in classes else None


def pane(tag, attrs, classes):
    """active, cached or inactive, and behind a bar the pane's id."""
    if "tab-pane" not in classes:
        return None
    state = "active" if {"active", "show"} <= classes else "cached" if "cache-" in attrs.get("id", "") else "inactive"
    return f"{state}|{attrs.get('id', '')}"


def sign(tag, attrs, classes):
    """What the text key of an element says of its card."""
    return next((kind for key, kind in SIGNS.items() if key in attrs.get("data-i18n", "")), None)


def modifier(tag, attrs, classes):
    return attrs.get("data-modifier-id") or None


def _with(*wanted, tag=None):
    return lambda t, attrs, classes: "" if (tag is None or t == tag) and classes.issuperset(wanted) else None


def _tags(*names):
    return lambda t, attrs, classes: t if t in names else None


def _attr(name, value=None):
    return lambda t, attrs, classes: attrs[name] if attrs.get(name) and value in (None, attrs[name]) else None


def _here(mark: str) -> Column:
    """The node itself is marked."""
    return F.col(f"{mark}.node") == F.col("node_id")


def _state(place: str = "pane") -> Column:
    return F.split_part(F.col(f"{place}.value"), F.lit("|"), F.lit(1))


def _name(place: str = "pane") -> Column:
    return F.regexp_extract(f"{place}.value", r"\|(.*)$", 1)


def _nodes(pages: DataFrame, marks: dict, keep: set[str] | None = None, **asked) -> DataFrame:
    return marked_nodes(pages, marks, keep, **asked).repartition("page_id")


def _in_order(found: Column, *fields: str) -> Column:
    """Values of the rows that meet a condition, in document order."""
    rows = F.array_sort(F.collect_list(F.when(found, F.struct("node_id", *[F.col(f).alias(f.replace(".", "_")) for f in fields]))))
    return F.transform(rows, lambda r: r[fields[0].replace(".", "_")]) if len(fields) == 1 else rows


def _sometime(value: Column, found: Column, last: bool = False) -> Column:
    """The value of the first (or last) row that meets a condition."""
    return (F.max_by if last else F.min_by)(value, F.when(found, F.col("node_id")))


def _record(df: DataFrame, kind: Column, section: Column, key: Column, row: Column, *more) -> DataFrame:
    entity = F.col("page_id").cast("string")
    rid = record_id("record", entity=entity, kind=kind, section=section, key=key)
    place = locator(section, row, key)
    return df.select(rid.alias("record_id"), entity.alias("entity_id"), kind.alias("record_type"), section.alias("section_name"), "text", key.alias("key"), place.alias("source_locator"), *more)


def _sql(schema: pa.Schema) -> str:
    kinds = {_STRINGS: "array<string>", _INTS: "array<int>", pa.int32(): "int", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


# ---- T11, R02: cards


def _kind(signed: Column) -> Column:
    """A sign inside the card goes first; then old cards and those of cached panes are historical, current ones of other
    inactive panes related."""
    own, state = F.col("card.value"), _state()
    return F.coalesce(signed, F.when((own == "historical") | ((own == "current") & (state == "cached")), "historical").when((own == "current") & (state == "inactive"), "related").otherwise(own))


def cards(pages: DataFrame) -> DataFrame:
    """page_id, node_id, last_id, kind of every card (div.card, or popupItem of any element): corrosion or drop_source by
    the text keys inside, historical, related, current, or other (no item)."""
    nodes = _nodes(pages, {"card": card, "pane": pane, "sign": sign}, {"card"}, fields=["last_id"], texts=False, plain=set())
    whole = nodes.groupBy("page_id", F.col("card.node").alias("n")).agg(
        F.max(F.when(_here("card"), F.struct("last_id", "card", "pane"))).alias("c"), _sometime(F.col("sign.value"), _here("sign"), last=True).alias("signed"))
    flat = whole.select("page_id", F.col("n").alias("node_id"), "c.*", "signed")
    return flat.select("page_id", "node_id", "last_id", _kind(F.col("signed")).alias("kind"))


def card_records(pages: DataFrame) -> DataFrame:
    """Records of current and corrosion cards, from their outermost modifiers with a text: a base stat outside tierParent,
    else an affix; the variant of a card is its first base stat."""
    nodes = _nodes(pages, {"card": card, "pane": pane, "sign": sign, "modifier": modifier, "tier": _with("tierParent")}, {"card"}, fields=["text"], texts=False, plain=set())
    w = Window.partitionBy("page_id", "card.node")
    rows = nodes.withColumn("kind", _kind(_sometime(F.col("sign.value"), _here("sign"), last=True).over(w)))
    rows = rows.filter(F.col("kind").isin("current", "corrosion") & _here("modifier") & (F.col("modifier.top") == F.col("node_id")) & (F.col("text") != ""))
    rows = rows.withColumn("type", F.when(F.col("tier").isNotNull(), "affix").otherwise("base_stat"))
    rows = rows.withColumn("variant", _sometime(F.col("text"), F.col("type") == "base_stat").over(w)).withColumn("row_index", F.row_number().over(w.orderBy("node_id")) - 1)
    rows = rows.withColumn("card_id", F.col("card.node"))
    return _record(rows, F.col("type"), F.col("kind"), F.concat(F.lit("modifier:"), F.col("modifier.value")), F.col("row_index"), "variant", "card_id")


# ---- R03: pages with panes


_STRINGS, _INTS = pa.list_(pa.string()), pa.list_(pa.int32())
_UNITS = pa.schema([("kinds", _STRINGS), ("panes", _STRINGS), ("own", _STRINGS), ("whole", _STRINGS), ("modifiers", _STRINGS), ("tiers", _STRINGS)])
_UNITS_SQL = ", ".join(f"{f.name} array<string>" for f in _UNITS)
_PANE_KINDS = ("base_affix", "base_stat", "craft_affix", "legendary_affix", "special_mechanic")


def _pane_units(nodes: list[list]) -> Iterator[tuple]:
    """What may be a record of a page with panes, by kind and in order: its kind, pane (state and id), the text of its own, all that its texts say (mechanics), modifier and
    tier. Stats and mechanics of every pane are told, as the page's name tells which count."""
    units, begun, over, ruled = {}, set(), set(), set()  # panes with a current card, and with an old one behind it; blocks with a rule
    for n, tag, _, own, text, (pane_, popup_, modifier_, detail, row, cell, tiered) in nodes:
        if popup_ and popup_[0] == n:
            if popup_[2] == "current":
                begun.add(pane_[0])
            elif pane_[0] in begun:
                over.add(pane_[0])
        if tag == "hr" and detail:
            ruled.add(detail[0])
        now, here = pane_[0] in begun and pane_[0] not in over, modifier_ and modifier_[0] == n
        outer, named = here and modifier_[1] == n, _PANE_ID.search(pane_[2])
        name = named and named[1]
        kind = "base_affix" if name == BASE_PANE else "craft_affix" if name == CRAFT_PANE else None
        found = []
        if now and outer:
            found.append(("base_stat", n, pane_[2]))
        if now and detail and detail[0] not in ruled:
            found.append(("special_mechanic", detail[0], pane_[2]))
        if kind and row:
            found.append((kind, row[0], ""))
        if name == LEGENDARY_PANE and outer:
            found.append(("legendary_affix", n, ""))
        for unit in found:
            one = units.setdefault(unit, [None, [], [], None])  # first modifier with its text, texts, cells, tier
            if here and one[0] is None:
                one[0] = modifier_[2], text
            if tag == "#text":
                one[1].append(own)
            if cell and cell[0] == n:
                one[2].append(text)
            if tiered and tiered[0] == n and one[3] is None:
                one[3] = tiered[2]
    rows = []
    for unit in sorted(units):
        first, texts, cells, tier = units[unit]
        said = cells[1] if len(cells) > 1 else None
        rows.append((unit[0], unit[2], said if unit[0] in ("base_affix", "craft_affix") else first and first[1], " ".join(texts), first and first[0], tier))
    if rows:
        yield tuple(zip(*rows))


def pane_records(pages: DataFrame) -> DataFrame:
    """Records of pages(page_id, title, html) with panes: base stats and the special mechanic of the pane that is named
    like the page, from its first current card up to the next historical one; affixes of the base table and, with tiers, of the crafting
    tables; the list of legendary affixes. Columns of a record, and tier.

    Stats and legendary affixes are outermost modifiers; a mechanic is what a block of kind detail says before its first
    rule; an affix is the second cell of a table row that has cells. A page's units are told while it is parsed, and numbered within its own row, so nothing is dealt."""
    titled = pages.select(F.struct("page_id", "title").alias("page_id"), "html")
    marks = {"pane": pane, "popup": popup, "modifier": modifier, "detail": _attr("data-block", "detail"), "row": _tags("tr"), "cell": _tags("td"),
        "tiered": lambda t, a, c: a.get("data-tier")}
    loose = {"data-modifier-id": '[^"&<>]+', "data-tier": '[^"&<>]+', "id": rf'(?!(?:{BASE_PANE}|{CRAFT_PANE}|{LEGENDARY_PANE})")(?:(?!cache-)[^"&<>\r\n\x85\u2028\u2029])+'}
    told = page_rows(titled, marks, _pane_units, _UNITS, _UNITS_SQL, {"pane"}, attrs=set(), texts={"detail"}, plain={"hr"}, said={"modifier", "cell"}, loose=loose, cleaned={"own"})
    mechanic = lambda u: u["kinds"] == "special_mechanic"
    whole = F.transform(F.arrays_zip(*_UNITS.names), lambda u: F.struct(
        u["kinds"].alias("kind"), u["panes"].alias("pane"), F.when(mechanic(u), clean(u["whole"])).otherwise(u["own"]).alias("text"), u["modifiers"].alias("modifier_id"), u["tiers"].alias("tier_value")))
    named = lambda u: F.coalesce(F.regexp_extract(u["pane"], r"\|(.*)$", 1) == F.col("page_id.title"), F.lit(False))
    counts = lambda u: F.coalesce(u["text"] != "", F.lit(False)) & (~u["kind"].isin("base_stat", "special_mechanic") | named(u))
    numbered = lambda kind: F.transform(F.filter("units", lambda u: u["kind"] == kind), lambda u, i: F.struct(u["kind"].alias("kind"), u["text"].alias("text"),
        u["modifier_id"].alias("modifier_id"), u["tier_value"].alias("tier_value"), i.alias("row_index")))
    units = told.select("page_id", whole.alias("units")).select("page_id", F.filter("units", counts).alias("units"))
    rows = units.select(F.col("page_id.page_id").alias("page_id"), F.explode(F.concat(*[numbered(k) for k in _PANE_KINDS])).alias("u")).select("page_id", "u.*")
    kind = F.col("kind")
    section = F.when(kind == "base_affix", BASE_PANE).when(kind == "craft_affix", CRAFT_PANE).when(kind == "legendary_affix", LEGENDARY_PANE).when(kind == "base_stat", "entity_card").otherwise("special_mechanic")
    key = F.when(kind == "special_mechanic", "section:special_mechanic").otherwise(stable_key(F.col("modifier_id"), F.col("row_index")))
    tier = F.when(kind == "craft_affix", F.coalesce(tier_name(F.col("tier_value")), F.lit("all")))
    return _record(rows, kind, section, key, F.col("row_index"), tier.alias("tier"))


# ---- R05: recipe cards and sequence rows


def _of_unit(nodes: list[list]) -> Iterator[tuple]:
    """Units of a section with a modifier, by number, with what they hold, in order: all texts as written, values and texts of modifiers, ids, targets and texts of links, values and texts of chips, and cells."""
    units, end, now = [], -1, None
    for r in nodes:
        n, tag, _, own, text, (section, unit, *marks) = r[:6]
        if unit and unit[0] == n and (-1 if unit[3] is None else unit[3]) < section[0]:
            now, end = ([], [], [], [], [], [], [], [], []), r[7]
            units.append(now)
        if now is None or n > end:
            continue
        if tag == "#text":
            now[0].append(own)
            continue
        modifier_, link, chip, cell, named = [m[2] if m and m[0] == n else None for m in marks]
        for at, v in ((1, modifier_), (4, link), (6, chip)):
            if v is not None:
                now[at].append(v)
                now[at + 1].append(text)
        if named is not None:
            now[3].append(named)
        if cell is not None:
            now[8].append(text)
    for k, (texts, modifiers, said, recipes, links, names, chips, chip_texts, cells) in enumerate(u for u in units if u[1]):
        yield k, " ".join(texts), modifiers, said, recipes, links, names, chips, chip_texts, cells


_HELD = pa.schema([("row_index", pa.int32()), ("written", pa.string()), *[(k, _STRINGS) for k in ("modifiers", "said", "recipes", "links", "names", "chips", "chip_texts", "cells")]])


def _listed(pages: DataFrame, section: str, unit: str) -> DataFrame:
    """One row for each card (outermost div.col) or table row inside a section that holds a modifier, with what it holds, in order, told while its page is parsed."""
    marks = {"section": _attr("id", section), "unit": _with("col", tag="div") if unit == "col" else _tags(unit), "modifier": modifier, "link": lambda t, a,
        c: a["href"] if t == "a" and a.get("href") else None, "chip": _attr("data-chip"), "cell": _tags("td"), "named": _attr("data-id")}
    loose = {k: '[^"&<>]+' for k in ("data-modifier-id", "href", "data-chip", "data-id")}
    told = page_rows(pages, marks, _of_unit, _HELD, _sql(_HELD), {"section"}, attrs=set(), texts={"unit"}, plain=set(), loose=loose, cleaned={"said", "names", "chip_texts", "cells"}, placed=True)
    some = lambda c, by: F.array_join(F.filter(c, lambda t: t != ""), by)
    # Behind explode, as Spark would clean the text again for each look at it.
    return told.select("page_id", "row_index", F.explode(F.array(clean(F.col("written")))).alias("whole"), "modifiers", some("said", "\n").alias("text"), "recipes",
        F.arrays_zip(F.col("links").alias("link_value"), F.col("names").alias("text")).alias("links"), "chips", some("chip_texts", " ").alias("chip_text"), "cells")


def _one_of(names: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.nullif(c, F.lit("")))


def recipe_cards(pages: DataFrame) -> DataFrame:
    """One record for each recipe card with a modifier: talent_type, recipe_id, and materials (name, route, quantity). A
    quantity is the number behind x where the material's name stands in the card with one first; null without."""
    cut = _listed(pages, RECIPES, "col")
    talent = F.regexp_extract("whole", rf"({'|'.join(TALENTS)})\s+Lv\.\d+", 1)
    amount = lambda m: F.nullif(F.call_function("regexp_extract", F.col("whole"), F.concat(F.lit(r"\Q"), m["text"], F.lit(r"\E\s*x(\d+)")), F.lit(1)), F.lit("")).cast("int")
    materials = F.transform("links", lambda m: F.struct(m["text"].alias("name"), F.concat(F.lit("/cn/"), m["link_value"], F.lit("/")).alias("route"), amount(m).alias("quantity")))
    rows = cut.withColumn("materials", materials).withColumn("talent", F.nullif(talent, F.lit("")))
    return _record(rows, F.lit("recipe"), F.coalesce("talent", F.lit(RECIPES)), F.concat(F.lit("modifier:"), F.get("modifiers", 0)), F.col("row_index"),
                   _one_of(TALENTS, F.col("talent")).alias("talent_type"), F.get("recipes", 0).alias("recipe_id"), "materials")


def sequence_rows(pages: DataFrame) -> DataFrame:
    """One record for each row of the sequence table with a modifier: tier and pattern of the sequence, and the equipment
    (second cell)."""
    cut = _listed(pages, SEQUENCES, "tr")
    tier = F.nullif(F.regexp_extract("chip_text", f"({'|'.join(SEQUENCE_TIERS)})", 1), F.lit(""))
    rows = cut.withColumn("tier", tier).withColumn("pattern", F.get("chips", 0)).withColumn("equipment", F.get("cells", 1))
    section = F.concat_ws(" · ", F.concat_ws(" ", "tier", "pattern"), "equipment")
    return _record(rows, F.lit("sequence"), section, F.concat(F.lit("modifier:"), F.get("modifiers", 0)), F.col("row_index"), _one_of(SEQUENCE_TIERS, F.col("tier")).alias("sequence_tier"), "pattern", "equipment")


# ---- R09: traits


_TRAITS = pa.schema([("heads", _STRINGS), ("boxes", _INTS), ("under", _INTS), ("required", _STRINGS), ("icons", _STRINGS), ("titles", _STRINGS), ("title_of", _INTS), ("tiers", _STRINGS), ("tier_of", _INTS),
    ("lines", _STRINGS), ("line_of", _INTS), ("line_tier", _INTS)])


def _trait_boxes(nodes: list[list]) -> Iterator[tuple]:
    """Boxes of a page by number, with all that trait_levels looks at: texts of headers, and the headers that each box stands beside (under: box * headers + header); texts of
    the boxes' parts, of names, of level marks and of lines, each with the box (and the mark) that it belongs to. A line's texts are as written."""
    heads, boxes = [], {}
    for node in nodes:
        n, _, _, _, text, (box, _, _, _, header) = node[:6]
        if header and header[0] == n:
            heads.append((text, node[6], node[8]))
        if box:
            boxes.setdefault(box[0], []).append(node)
    out = [[] for _ in _TRAITS]
    heads_, names, under, required, icons, titles, title_of, tiers, tier_of, lines, line_of, line_tier = out
    heads_ += [h[0] for h in heads]
    for at in sorted(boxes):
        rows = boxes[at]
        grow = next((r for r in rows if r[5][1] and r[5][1][0] == r[0] and r[6] == at), None)
        if grow is None:
            continue
        c, last = grow[0], grow[7]
        bolds = [r for r in rows if r[5][2] and r[5][2][0] == r[0] and r[6] == c]
        if not bolds:
            continue
        k = len(names)
        names.append(at)
        under += [k * len(heads) + i for i, (_, parent, end) in enumerate(heads) if parent is not None and parent < at <= end]
        required.append(grow[4])
        image = next((r for r in rows if r[1] == "img"), None)
        icons.append(next((v for key, v in image[2] if key == "alt"), None) if image else None)
        inside = [r for r in rows if c < r[0] <= last]
        named = [r[4] for r in inside if r[5][2] and r[5][2][0] == r[0]]
        titles += named
        title_of += [k] * len(named)
        tiered = any(r[5][3] and r[5][3][0] == r[0] for r in inside)
        tier, closed, child, said = None, False, -1, {}
        for r in inside:
            n, tag, parent = r[0], r[1], r[6]
            if r[5][3] and r[5][3][0] == n:
                tier, closed = r, False
                tiers.append(r[4])
                tier_of.append(k)
            if tag != "#text" and parent == c:
                child = n
            if tag == "hr" and tier and parent == tier[6]:
                closed = True
            if tag != "#text":
                continue
            if not tiered:
                if parent != c and not bolds[0][0] <= n <= bolds[0][7]:
                    said.setdefault((-1, child, r[9]), []).append(r[3])
            elif tier and not closed and n <= tier[8] and parent != tier[6] and (not r[5][3] or r[5][3][0] != tier[0]):
                said.setdefault((len(tiers) - 1, child, r[9]), []).append(r[3])
        for key in sorted(said):
            lines.append(" ".join(said[key]))
            line_of.append(k)
            line_tier.append(key[0])
    if names and heads:
        yield tuple(out)


def trait_levels(pages: DataFrame) -> DataFrame:
    """One record for each level of each trait of a hero's page: node_name, required_level, trait_level (null: the
    trait has none), icon and occurrence, key asset:<icon>:occurrence:<n>:level:<level or unspecified>.

    Traits are the boxes (d-flex, border-top, with a direct flex-grow-1 that has a direct fw-bold) of the card whose h5 header is
    `<name> - <trait> / <n>`. A level begins at a tierLevel element that names it and takes the elements that follow it
    in the same parent, up to the next such element or a rule; texts that stand free there belong to none. A box without
    such elements has one level: the lines of all but its title, without the demand of a level and controls. A page's boxes are told while it is parsed, so nothing is dealt."""
    marks = {"box": _with("d-flex", "border-top"), "grow": _with("flex-grow-1"), "bold": _with("fw-bold"), "tier": _with("tierLevel"), "header": lambda t, a, c: "" if t == "h5" and "card-header" in c else None}
    told = page_rows(pages, marks, _trait_boxes, _TRAITS, _sql(_TRAITS), {"box", "header"}, attrs={"alt"}, loose={"alt": '[^"&<>]+'}, cleaned={"heads", "required", "titles", "tiers"}, placed=True)
    first = F.get(F.filter(F.transform("heads", lambda h, i: F.struct(i.alias("i"), h.alias("h"))), lambda h: h["h"].rlike(TRAIT_HEADER)), 0)["i"]
    zipped = lambda *c: F.arrays_zip(*[F.col(x).alias(x) for x in c])
    of = lambda part, i: F.filter(part, lambda x: x["of"] == i)
    # Behind explode, as Spark would put what stands here into the functions below, and work it out for each box.
    parts = told.select("page_id", F.explode(F.array(F.struct("boxes", "required", "icons", "under", F.size("heads").alias("n_heads"), first.alias("first"),
        F.transform(zipped("titles", "title_of"), lambda x: F.struct(x["title_of"].alias("of"), x["titles"].alias("title"))).alias("names"),
        F.transform(zipped("tiers", "tier_of"), lambda x, i: F.struct(x["tier_of"].alias("of"), i.alias("i"), extract_number(x["tiers"], TRAIT_LEVEL).alias("level"))).alias("marked"),
        F.transform(zipped("lines", "line_of", "line_tier"), lambda x: F.struct(x["line_of"].alias("of"), x["line_tier"].alias("i"), clean(x["lines"]).alias("line"))).alias("told")))).alias("p")).select("page_id", "p.*")
    box = lambda b, i: F.struct(b["boxes"].alias("box"), F.array_contains("under", i * F.col("n_heads") + F.col("first")).alias("there"),
        F.coalesce(F.get(F.filter(of(F.col("names"), i), lambda x: x["title"] != ""), 0)["title"], F.lit("")).alias("title"), F.nullif(clean(b["icons"]), F.lit("")).alias("icon"),
        extract_number(b["required"], REQUIRED_LEVEL).alias("required"), of(F.col("marked"), i).alias("marked"), of(F.col("told"), i).alias("told"))
    boxes = parts.filter("first is not null").select("page_id", F.explode(F.array(F.filter(F.transform(zipped("boxes", "required", "icons"), box), lambda b: b["there"]))).alias("boxes"))
    alike = lambda b, i: F.size(F.filter(F.slice(F.col("boxes"), 1, i + 1), lambda o: o["icon"].eqNullSafe(b["icon"])))
    none = F.lit(None).cast("int")

    def levels(b, i):
        drop = lambda x: (F.size(b["marked"]) == 0) & ((x["line"] == b["title"]) | x["line"].rlike(f"^{REQUIRED_LEVEL}$") | x["line"].isin(*CONTROLS))
        said = lambda found: clean(F.array_join(F.transform(F.filter(b["told"], lambda x: found(x) & (x["line"] != "") & ~drop(x)), lambda x: x["line"]), " "))
        record = lambda level, text: F.struct(level.alias("level"), text.alias("text"), b["title"].alias("title"), b["icon"].alias("icon"), b["required"].alias("required"), alike(b, i).alias("occurrence"))
        named = F.filter(b["marked"], lambda m: m["level"].isNotNull())
        plain = F.when(F.size(b["marked"]) > 0, "").otherwise(said(lambda x: F.lit(True)))
        return F.when(F.size(named) > 0, F.transform(named, lambda m: record(m["level"], said(lambda x: x["i"] == m["i"])))).otherwise(F.array(record(none, plain)))

    rows = boxes.select("page_id", F.posexplode(F.flatten(F.transform("boxes", levels))).alias("row_index", "r")).select("page_id", "row_index", "r.*")
    key = F.concat(F.lit("asset:"), F.coalesce("icon", F.lit("")), F.lit(":occurrence:"), F.col("occurrence").cast("string"), F.lit(":level:"), F.coalesce(F.col("level").cast("string"), F.lit("unspecified")))
    return _record(rows, F.lit("trait"), F.lit("trait"), key, F.col("row_index"), F.col("title").alias("node_name"), F.col("required").alias("required_level"), F.col("level").alias("trait_level"), "icon", F.col("occurrence").cast("int").alias("occurrence"))


# ---- R11: skills


_SKILLS = pa.schema([("cards", pa.int32()), ("title", pa.string()), *[(k, _STRINGS) for k in ("tags", "weapons", "centred", "effects", "ids", "firsts", "grown", "texts")]])


def _skill_parts(nodes: list[list]) -> Iterator[tuple]:
    """What skill_pages looks at, of one page: how many current cards it has, and, if it is one, texts of the card's parts, modifiers with the first cell of their rows, and all texts."""
    here = lambda r, k: r[5][k] and r[5][k][0] == r[0]
    away = lambda r: bool(r[5][1]) and r[5][1][2].partition("|")[0] in ("cached", "inactive")
    cards = [r for r in nodes if here(r, 0) and r[5][0][2] == "current" and not away(r)]
    if len(cards) != 1:
        yield len(cards), None, *[[]] * 8
        return
    begin, end = cards[0][0], cards[0][7]
    inside = [r for r in nodes if begin < r[0] <= end]
    firsts: dict[int, str] = {}
    for r in nodes:
        if here(r, 5) and r[5][4] and r[6] == r[5][4][0]:
            firsts.setdefault(r[6], r[4])
    texts = lambda k: [r[4] for r in inside if here(r, k)]
    tagged = [r[0] for r in inside if here(r, 7)]
    centred = [r[4] for r in inside if here(r, 9) and not any(r[0] < t <= r[7] for t in tagged)]
    grown = [r for r in nodes if here(r, 3) and not r[5][2] and not away(r)]
    titles = texts(6)
    yield (1, titles[0] if titles else None, texts(7), texts(8), centred, texts(10), [r[5][3][2] for r in grown], [firsts.get(r[5][4][0]) if r[5][4] else None for r in grown], [r[4] for r in grown],
           [r[3] for r in nodes if r[1] == "#text"])


def skill_pages(pages: DataFrame) -> DataFrame:
    """Of each page with exactly one current card one effect record, and a growth record for each modifier outside old cards and
    inactive panes (in order of the page, nested ones too). Columns of a record, and tier.

    An effect is the card's title, its tags, weapon restrictions, centred attributes (blocks without a tag inside) and explicit effects, each
    different one once, in the order of the card. A modifier's tier is the first cell of its table row; where an id occurs
    twice on a page, the tier is part of the key. The effect's key is the id of its info card, skill:<id>."""
    marks = {"popup": popup, "pane": pane, "old": _with("previousItem"), "modifier": modifier, "row": _tags("tr"), "cell": _tags("td", "th"), "title": _with("card-title"), "tagged": _with("tag"),
             "weapon": _attr("data-block", "weapon_restrict_description"), "centred": _with("d-flex", "justify-content-center"), "effect": _with("explicitMod")}
    told = page_rows(pages, marks, _skill_parts, _SKILLS, _sql(_SKILLS), attrs=set(), plain=set(), loose={"data-modifier-id": '[^"&<>]+'},
        cleaned={"title", "tags", "weapons", "centred", "effects", "firsts", "grown"}, placed=True)
    some = lambda c: F.array_distinct(F.filter(c, lambda x: x != ""))
    skill_id = F.regexp_extract(F.get(F.filter("texts", lambda x: x.rlike(SKILL_ID)), 0), SKILL_ID, 1)
    growth = F.arrays_zip(F.col("ids").alias("modifier_value"), F.col("firsts").alias("first"), F.col("grown").alias("text"))
    whole = told.select("page_id", "cards", F.coalesce("title", F.lit("")).alias("title"), some("tags").alias("tags"), some("weapons").alias("weapons"), some("centred").alias("centred"), some("effects").alias("effects"),
        growth.alias("growth"), skill_id.alias("skill_id"))
    # Pages that share an id are one page with all their cards.
    whole = whole.withColumn("cards", F.sum("cards").over(Window.partitionBy("page_id"))).filter("cards = 1")
    parts = F.flatten(F.array(F.array("title"), F.when(F.size("tags") > 0, F.array(F.concat(F.lit(TAGS), F.array_join("tags", "、")))).otherwise(F.array().cast("array<string>")),
        F.col("weapons"), F.col("centred"), F.col("effects")))
    effect = F.struct(F.lit("skill_effect").alias("kind"), F.lit(0).alias("row"), F.concat(F.lit("skill:"), F.coalesce("skill_id", F.lit(""))).alias("key"),
        F.array_join(F.filter(parts, lambda p: p != ""), " ").alias("text"), F.lit(None).cast("string").alias("tier"))
    twice = lambda g: F.size(F.filter("growth", lambda o: o["modifier_value"] == g["modifier_value"])) > 1
    key = lambda g: F.concat(F.lit("modifier:"), g["modifier_value"], F.when(twice(g), F.concat(F.lit(":tier:"), F.coalesce(g["first"], F.lit("")))).otherwise(""))
    growth = F.transform("growth", lambda g, i: F.struct(F.lit("skill_growth").alias("kind"), i.alias("row"), key(g).alias("key"), g["text"].alias("text"), F.coalesce(g["first"], F.lit("unknown")).alias("tier")))
    out = whole.select("page_id", F.explode(F.concat(F.array(effect), growth)).alias("r")).select("page_id", "r.*")
    return _record(out, F.col("kind"), F.col("kind"), F.col("key"), F.col("row"), "tier")


# ---- R07: contracts


def _idle_npc(tag, attrs, classes):
    return "" if tag == "div" and "tab-pane" in classes and attrs.get("id", "").endswith("_NPC") and not {"active", "show"} & classes else None


def contract_records(pages: DataFrame) -> DataFrame:
    """One record for each box (div.d-flex.border.rounded) outside idle NPC panes, scripts, navigation and tables, whose images name id
    and level: the texts of its parts, the div children of div.flex-grow-1.ms-2, of which there are two or more, name and
    effect; a third is its context. Key contract:<id>:level:<n>; the last id and level in a box count."""
    marks = {"box": _with("d-flex", "border", "rounded", tag="div"), "flex": _with("flex-grow-1", "ms-2", tag="div"), "idle": _idle_npc, "blocked": _tags("script", "style", "nav", "footer", "table")}
    nodes = _nodes(pages, marks, {"box"}).filter("idle is null and blocked is null")
    begun = F.last(F.when((F.col("tag") == "div") & (F.col("parent_id") == F.col("flex.node")), F.struct("node_id", "last_id")), True).over(Window.partitionBy("page_id", "box.node").orderBy("node_id"))
    nodes = nodes.withColumn("p", begun)
    said = (F.col("tag") == "#text") & (F.col("node_id") <= F.col("p.last_id"))
    at = lambda k: F.try_element_at("attrs", F.lit(k))
    newest = lambda k: _sometime(at(k), (F.col("tag") == "img") & at(k).isNotNull(), last=True).alias(k)
    parts = nodes.groupBy("page_id", F.col("box.node").alias("box"), F.when(F.col("node_id") <= F.col("p.last_id"), F.col("p.node_id")).alias("part")).agg(
        clean(F.array_join(_in_order(said, "own_text"), " ")).alias("said"), newest("data-id"), newest("data-level"), F.max("node_id").alias("node_id"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "said")))), lambda x: x["said"])
    known = lambda k: F.nullif(_sometime(F.col(k), F.col(k).isNotNull(), last=True), F.lit(""))
    boxes = parts.groupBy("page_id", "box").agg(listed.alias("parts"), known("data-id").alias("id"), known("data-level").alias("level")).filter("id is not null and level is not null and size(parts) >= 2")
    rows = boxes.withColumn("text", F.trim(F.concat_ws(" ", F.get("parts", 0), F.get("parts", 1)))).withColumn("row_index", F.row_number().over(Window.partitionBy("page_id").orderBy("box")) - 1)
    return _record(rows, F.lit("contract"), F.lit(CONTRACTS), F.concat_ws(":", F.lit("contract"), "id", F.lit("level"), "level"), F.col("row_index"), F.get("parts", 0).alias("node_name"), F.get("parts", 2).alias("node_context"))


# ---- R08, R10: fates and talents


def fate_records(pages: DataFrame) -> DataFrame:
    """One record a page: the first modifier of its current cards (div.ui_item.popupItem without
    previousItem), else their first description block with a text, located by section. Of nested ones in a card the outer counts."""
    own = lambda t, attrs, classes: ("old" if "previousItem" in classes else "current") if t == "div" and classes.issuperset(("ui_item", "popupItem")) else None
    part = lambda t, attrs, classes: "modifier" if attrs.get("data-modifier-id") else "description" if attrs.get("data-block") == "description2" else None
    nodes = marked_nodes(pages, {"own": own, "part": part}, {"own"}, fields=["attrs", "text"], attrs={"data-modifier-id"}, texts=False, plain=set()).filter(_here("part") & (F.col("own.value") == "current") & (F.coalesce("part.outer", F.lit(-1)) < F.col("own.node")))
    known = F.struct(F.try_element_at("attrs", F.lit("data-modifier-id")).alias("modifier_id"), "text")
    page = nodes.groupBy("page_id").agg(_sometime(known, F.col("part.value") == "modifier").alias("m"), _sometime(known, (F.col("part.value") == "description") & (F.col("text") != "")).alias("d")).filter("m is not null or d is not null")
    has = F.col("m").isNotNull()
    return page.select("page_id", F.when(has, "fate_effect").otherwise("fate_entity_effect").alias("record_type"), F.when(has, F.concat(F.lit("modifier:"), F.col("m.modifier_id"))).otherwise("section:current_description2").alias("key"),
                       F.coalesce("m.text", "d.text").alias("text"), F.when(has, "record").otherwise("section").alias("locator_level"), F.when(has, "high").otherwise("medium").alias("confidence"))


def talent_records(pages: DataFrame, named_kinds: bool = False) -> DataFrame:
    """Talents of a page in order. A talent is an outermost div.col outside inactive panes that holds an
    element with data-talent-id, whose text is the name; behind it stand <n>pts, <a>/<b> and the effect. The kind is told
    by how the name begins; with named_kinds (pages with supreme talents) others are `named`, else `major_named`."""
    shown = lambda t, attrs, classes: ("active" if classes.issuperset(("active", "show")) else "idle") if t == "div" and "tab-pane" in classes else None
    nodes = _nodes(pages, {"col": _with("col", tag="div"), "shown": shown, "talent": _attr("data-talent-id")}, {"col"}, fields=["tag", "own_text", "text"], plain=set())
    whole = nodes.groupBy("page_id", F.col("col.top").alias("node_id")).agg(
        F.max(F.when(F.col("node_id") == F.col("col.top"), F.coalesce("shown.value", F.lit("active")))).alias("state"), _sometime(F.col("talent.value"), _here("talent"), last=True).alias("talent_id"),
        clean(F.array_join(_in_order(_here("talent"), "text"), " ")).alias("name"), clean(F.array_join(_in_order(F.col("tag") == "#text", "own_text"), " ")).alias("text")).filter("state = 'active' and talent_id is not null")
    rest = F.when((F.col("name") != "") & F.startswith("text", F.col("name")), F.trim(F.substr("text", F.length("name") + 1))).otherwise(F.col("text"))
    kind = F.when(F.startswith("name", F.lit(SUPREME)), "supreme") if named_kinds else F
    for begin, value in TALENT_NAMES.items():
        kind = kind.when(F.startswith("name", F.lit(begin)), value)
    at = F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")) - 1
    number = lambda i: extract_number(F.col("rest"), POINTS, i)
    return whole.withColumn("rest", rest).select("page_id", "talent_id", at.alias("row_index"), "name", number(1).alias("points"), number(2).alias("allocated"), number(3).alias("maximum"),
                                                 F.trim(F.regexp_replace("rest", POINTS, "")).alias("effect"), kind.otherwise("named" if named_kinds else "major_named").alias("kind"))
