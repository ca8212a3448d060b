from __future__ import annotations

import random
import re
import threading

from pyspark.sql import functions as F

from lessonlake.dictionaries import MARKER_LABELS
from lessonlake.functions import text as T
from lessonlake.operators import sections, segments, structure
from lessonlake.plans import registry
from lessonlake.plans.registry import QUERIES


def as_lines(spark, rows, publication="m-maestro"):
    return spark.createDataFrame([(publication, i, x) for i, x in enumerate(rows, 1)], "publication_id string, line_number int, line string")


def contents(spark, rows):
    lines = as_lines(spark, ["===== PDF_PAGE 2 =====", "CONTENIDO", *rows])
    out = structure.contents_index(structure.contents_rows(lines, structure.contents_candidates(lines))).orderBy("line_number").collect()
    return [(r["lesson_number"], r["title"], r["page_start"], r["lesson_date"]) for r in out]


def test_contents_wrapped_pending_and_unfinished(spark):
    rows = ["03/mar/24", "1. La fe que", "obra .... 5", "10/mar/24", "17/mar/24", "2. Sin terminar", "3. El amor .... 12", "ruido", "4. Sin fecha 20"]
    assert contents(spark, rows) == [(1, "La fe que obra", 5, "03/mar/24"), (3, "El amor", 12, "17/mar/24"), (4, "Sin fecha", 20, None)]


def test_contents_completes_early_on_a_number(spark):
    assert contents(spark, ["1. Los 12", "apóstoles 7"]) == [(1, "Los", 12, None)]


def sequential(rows):
    """The contents parse as a plain loop."""
    import re

    out, date, number, said = [], None, None, ""

    def entry():
        m = re.match(r"^(.*?)(\d{1,4})\s*$", said)
        if not m:
            return None
        title = re.sub(r"\s+", " ", re.sub(r"\.{2,}", " ", m.group(1))).strip(" .")
        return (number, title, int(m.group(2)), date) if title else None

    for s in rows:
        if re.match(r"^\d{1,2}/[A-Za-z]{3}/\d{2}$", s):
            date = s
            continue
        m = re.match(r"^(\d{1,3})\.\s*(.+)$", s)
        if m:
            number, said = int(m.group(1)), m.group(2)
        elif number is not None:
            said += " " + s
        else:
            continue
        e = entry()
        if e:
            out.append(e)
            date, number = None, None
    return out


def test_contents_equal_the_sequential_parse(spark):
    rng = random.Random(5)
    pool = ["03/mar/24", "10/abr/24", "1. Uno", "2. Dos 5", "3. Tres ... 9", "sigue", "y acaba 7", "4. Cuatro 4 veces", "resto"]
    for _ in range(12):
        rows = [rng.choice(pool) for _ in range(rng.randint(1, 12))]
        assert contents(spark, rows) == sequential(rows), rows


def test_contents_of_odd_lines_equal_the_sequential_parse(spark):
    """Dots, numbers or line ends alone or inside, and entries that never end; all at once, one publication each."""
    rng = random.Random(6)
    pool = ["03/mar/24", "10/abr/24", "1. Uno", "2. 7", "3. .. 9", "4. ...", "5.Cinco 12345", "1000. Mil 8", "....", ". 6", "5", "12345", "sigue", "a\nb 3", "a\nb", "y 7", "6. x\u00a0.\u00a04", "\u00a0"]
    texts = {f"m-{i}": [rng.choice(pool) for _ in range(rng.randint(1, 14))] for i in range(400)}
    rows = [(p, i, x) for p, said in texts.items() for i, x in enumerate(["===== PDF_PAGE 2 =====", "CONTENIDO", *said], 1)]
    lines = spark.createDataFrame(rows, "publication_id string, line_number int, line string")
    got = {p: [] for p in texts}
    for r in structure.contents_index(structure.contents_rows(lines, structure.contents_candidates(lines))).orderBy("line_number").collect():
        got[r["publication_id"]].append((r["lesson_number"], r["title"], r["page_start"], r["lesson_date"]))
    for p, said in texts.items():
        assert got[p] == sequential([x.strip() for x in said if x.strip()]), said


def test_contents_with_many_lines_behind_the_last_entry(spark):
    """Numbers above 999 start no entry, so all lines from there on lie behind the last one: the work must not be their square."""
    rows = [x for n in range(990, 7000) for x in ("03/mar/24", f"{n}. El llamado a una vida de servicio", "..... 7")]
    stop = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        assert contents(spark, rows) == sequential(rows) == [(n, "El llamado a una vida de servicio", 7, "03/mar/24") for n in range(990, 1000)]
    finally:
        stop.cancel()


def test_markers_only_where_the_page_changes(spark):
    lines = as_lines(spark, ["===== PDF_PAGE 1 =====", "Lección 3 hoy", "===== PDF_PAGE 1 =====", "Título:", "texto", "===== PDF_PAGE 2 ====="])
    got = [(r["line_number"], r["marker_type"]) for r in structure.markers(lines).orderBy("line_number").collect()]
    assert got == [(1, "page_marker"), (2, "lesson_header"), (4, "section_label"), (6, "page_marker")]


def as_text(spark, rows):
    return spark.createDataFrame([(1, "\n".join(rows))], "k int, text string")


def test_reflow_joins_prose_and_keeps_structure(spark):
    rows = ["I. Primer punto", "Una frase que", "sigue aquí", "", "¿Pregunta", "otra línea", "Juan 3:16", "fin"]
    got = [r["text"] for r in structure.reflow(as_text(spark, rows), "k").orderBy("paragraph").collect()]
    assert got == ["I. Primer punto", "Una frase que sigue aquí", "¿Pregunta", "otra línea", "Juan 3:16", "fin"]


def test_reflow_is_idempotent(spark):
    rows = ["Una frase que", "sigue aquí", "", "A. Punto", "más texto"]
    once = [r["text"] for r in structure.reflow(as_text(spark, rows), "k").orderBy("paragraph").collect()]
    spaced = [x for t in once for x in (t, "")]
    assert [r["text"] for r in structure.reflow(as_text(spark, spaced), "k").orderBy("paragraph").collect()] == once


def test_segments_from_contents_and_headers(spark):
    rows = ["===== PDF_PAGE 1 =====", "Contenido", "1. Uno 3", "2. Dos 5", "===== PDF_PAGE 3 =====", "LECCIÓN 1", "a", "===== PDF_PAGE 5 =====", "LECCIÓN 2", "LECCIÓN 2", "b"]
    lines = as_lines(spark, rows)
    marks = structure.markers(lines)
    idx = structure.contents_index(structure.contents_rows(lines, structure.contents_candidates(lines)))
    s = [(r["lesson_number"], r["start_line"], r["end_line"], r["page_end"]) for r in segments.segments(idx, marks, lines).orderBy("lesson_number").collect()]
    assert s == [(1, 5, 7, 4), (2, 8, 11, 5)]
    m = {r["code"]: r["lesson_numbers"] for r in segments.messages(lines, idx, segments.segments(idx, marks, lines), marks).collect()}
    assert m == {"DUPLICATE_OBSERVED_LESSON_HEADERS": "2"}
    bare = as_lines(spark, ["LECCIÓN 7", "x"])
    none = idx.where("false")
    f = segments.segments(none, structure.markers(bare), bare).collect()
    assert [(r["lesson_number"], r["start_line"], r["end_line"]) for r in f] == [(7, 1, None)]


def test_composed_segments_of_a_publication_with_thousands_of_lessons(spark, tmp_path):
    """The contents hold lessons 1 to 999, the rest is behind them; segments must come in time all the same."""
    n, title = 6000, "El llamado a una vida de servicio"
    rows = spark.range(1, n + 1).select(F.lit("m-maestro").alias("publication_id"), F.col("id").cast("int").alias("lesson_number"), "id")
    rows.select("publication_id", "lesson_number", F.col("id").alias("segment_id"), F.lit(title).alias("expected_title"), (F.col("lesson_number") * 4).alias("page_start"), F.lit("03/mar/24").alias("lesson_date")).write.parquet(f"{tmp_path}/lesson_segments.parquet")
    rows.select("publication_id", "lesson_number", F.col("id").alias("reading_id"), F.lit("Juan 3:16").alias("reference_display")).write.parquet(f"{tmp_path}/biblical_readings.parquet")
    head, body = 2 + 3 * n, 19  # lines of the contents page, and of each lesson's page
    # no entry follows the last one, so it goes on to the end of the text
    want = [(k, head + body * (k - 1) + 1, head + body * k, 4 * k, 4 * k + 3) for k in range(1, 999)] + [(999, head + body * 998 + 1, head + body * n, 3996, 4 * n)]
    stop = threading.Timer(90, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        got = QUERIES["composed_lesson_segments"](spark, str(tmp_path)).orderBy("lesson_number").collect()
    finally:
        stop.cancel()
    assert [tuple(r[c] for c in ("lesson_number", "start_line", "end_line", "page_start", "page_end")) for r in got] == want
    assert {(r["marker"], r["expected_title"], r["lesson_date"]) for r in got} == {("Contenido", title, "03/mar/24")}


def test_composed_lines_carry_the_numbers_and_pages_of_a_sequential_scan(spark, tmp_path):
    """Titles, dates and readings may be null or page markers themselves, numbers null; no step goes over the lines again to number them."""
    marker, big = "===== PDF_PAGE 77 =====", "===== PDF_PAGE 99999999999 ====="
    given = [("b", 2, "Dos", 8, None, "Juan 3:16"), ("b", 1, marker, None, "03/mar/24", None), ("b", 10, f" {marker}\t", 40, marker, "Rut 1:1"), ("b", None, "Nada", 3, "10/mar/24", "Rut 2:2"), ("a", 5, None, 20, big, "Lucas 1:1"), (None, 4, "Sin casa", 1, None, "Judas 3"), ("a", 6, big, 24, marker, "Lucas 2:2")]
    kinds = "publication_id string, lesson_number int, expected_title string, page_start int, lesson_date string, reference_display string, segment_id long, reading_id long"
    df = spark.createDataFrame([(*g, i, i) for i, g in enumerate(given)], kinds)
    df.drop("reference_display", "reading_id").write.parquet(f"{tmp_path}/lesson_segments.parquet")
    df.select("publication_id", "lesson_number", "reading_id", "reference_display").write.parquet(f"{tmp_path}/biblical_readings.parquet")

    def page(line):
        m = re.fullmatch(r"===== PDF_PAGE (\d+) =====", line.strip())
        return int(m[1]) if m and int(m[1]) < 2**31 else None

    want = []
    for pub in (None, "a", "b"):
        own = sorted((g for g in given if g[0] == pub), key=lambda g: (g[1] is not None, g[1] or 0))
        lines = ["===== PDF_PAGE 1 =====", "CONTENIDO"]
        for _, n, title, start, date, _ in own:
            lines += [date, n and f"{n}. {title or 'Sin título'}", f"..... {7 if start is None else start}"]
        for _, n, title, _, _, read in own:
            read, t = read if pub and n else None, title or "Sin título"  # readings meet lessons by publication and number
            lines += [n and f"===== PDF_PAGE {4 * n} =====", n and f"LECCIÓN {n}", t, read and f"Lectura Bíblica: {read}", "Bosquejo de la lección", f"I. {t}", "A. primer punto", read and f"({read})", "sigue el punto", "12"]
            lines += ["Notas para el maestro: lea con la clase", "el pasaje de hoy.", f"¿{t}?", "Maestro", "repase la lección anterior", "y ore.", "Resumen y aplicación práctica: viva", "lo aprendido.", "Lecturas diarias"]
        active = None
        for at, line in enumerate((x for x in lines if x is not None), 1):
            before, active = active, active if page(line) is None else page(line)
            want.append((pub, at, line, active, before))
    got = registry.source_lines(spark, str(tmp_path))
    columns = ["publication_id", "line_number", "line", "active_page", "page_before"]
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=lambda r: (r[0] or "", r[1]))
    assert rows == want
    plain = structure.with_active_page(got.where("publication_id is not null").select(*columns[:3]))
    assert sorted(tuple(r[c] for c in columns) for r in plain.collect()) == [w for w in want if w[0]]


def test_section_labels_are_found_behind_any_first_letters(spark):
    texts = ["TÍTULO", "T\u0301itulo", "\u0301\u2003Lectura Bíblica: x", "lecturas", "L", "", "Ĺectura bíblica", "Bosquejo", "Bosquejo de la lección 2", "resumen y aplicacion practica", "la lectura biblica", "Título", "Contenidos"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r["x"] for r in df.select("i", T.starts_folded(F.col("t"), MARKER_LABELS).alias("x")).orderBy("i").collect()]
    assert got == [r["x"] for r in df.select("i", T.starts_with_any(T.fold(F.col("t")), MARKER_LABELS).alias("x")).orderBy("i").collect()]
    assert got == [True, True, True, False, False, False, True, False, True, True, False, True, True]
    words = ["CONTENIDO", " Índice\t", "I\u0301ndice", "Contenido y más", "", "contenido:", "Inicio"]
    assert [r["x"] for r in spark.createDataFrame(list(enumerate(words)), "i int, t string").select("i", T.is_contents_label(F.col("t")).alias("x")).orderBy("i").collect()] == [True, True, True, False, False, False, False]


LESSON = [
    "LECCIÓN 1", "La fe", "Lectura Bíblica: Isaías 53:4-6; Mateo 8:17", "Bosquejo de la lección", "I. La promesa", "A. Su alcance",
    "Notas para el maestro: ¿De qué aprovechará si alguno dice que", "tiene fe, pero no tiene obras?", "12", "Maestro", "Vocabulario", "Resumen y aplicación práctica: viva lo aprendido", "Lecturas diarias",
]


def test_sections_of_a_lesson(spark):
    lines = as_lines(spark, LESSON)
    seg = segments.from_headers(structure.markers(lines)).withColumn("end_line", F.lit(13))
    body = sections.body_lines(lines)
    found = sections.labels(body, seg)
    assert sections.readings(body, found).first()["reference_display"] == "Isaías 53:4-6; Mateo 8:17"
    got = {}
    for r in sections.items(sections.blocks(body, found), sections.outlines(body, found)).orderBy("section", "item_no").collect():
        got.setdefault(r["section"], []).append(r["text"])
    assert got == {"lesson_outline": ["I. La promesa", "A. Su alcance"], "teacher_notes": ["¿De qué aprovechará si alguno dice que tiene fe, pero no tiene obras?"], "summary_application": ["viva lo aprendido"]}


def test_item_kinds(spark):
    texts = ["TBD", " ", "IV. Fin", "C. Punto", "B. Punto", "(Juan 1:1)", "¿Quién?", "Prosa"]
    got = [r["k"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.item_kind(F.col("t")).alias("k")).orderBy("i").collect()]
    assert got == ["placeholder", "placeholder", "roman_heading", "roman_heading", "letter_subpoint", "scripture_reference", "question", "paragraph"]


def test_nulls_and_empty_tables(spark):
    pages = spark.createDataFrame([("p", 1, None, 1), ("p", 2, "", 2), (None, 3, "x", 3)], "publication_id string, page_number int, text string, page_id bigint")
    got = structure.lines_of_pages(pages).orderBy("publication_id", "line_number").collect()
    assert [r["line"] for r in got] == ["===== PDF_PAGE 3 =====", "x", "===== PDF_PAGE 1 =====", "===== PDF_PAGE 2 ====="]
    empty = as_lines(spark, [])
    assert structure.markers(empty).count() == structure.reflow(as_text(spark, []), "k").count() == structure.contents_candidates(empty).count() == 0


def test_lines_and_active_pages_equal_the_sequential_scan(spark, monkeypatch):
    monkeypatch.setattr(structure, "PAGES", 3)
    monkeypatch.setattr(structure, "BUCKET", 4)
    rng = random.Random(3)
    pages, want = [], []
    for pub in ("a", "b"):
        active, at = None, 0
        for number in [None, *sorted(rng.sample(range(40), 14))]:
            texts = ["\n".join(rng.choice(["uno", "", "===== PDF_PAGE 99 =====", "Lección 4", "dos"]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 2))]
            pages += [(len(pages) + k, pub, number, t) for k, t in enumerate(texts)]
            header = "===== PDF_PAGE null =====" if number is None else f"===== PDF_PAGE {number} ====="
            for line in [header, *texts[-1].splitlines()]:
                before, at = active, at + 1
                if line.startswith("=====") and "null" not in line:
                    active = int(line.split()[2])
                want.append((pub, at, line, active, before))
    df = spark.createDataFrame([(i, *p[1:]) for i, p in enumerate(pages)], "page_id bigint, publication_id string, page_number int, text string")
    lines = structure.lines_of_pages(df)
    got = sorted((r["publication_id"], r["line_number"], r["line"], r["active_page"], r["page_before"]) for r in lines.collect())
    assert got == want
    plain = structure.with_active_page(lines.select("publication_id", "line_number", "line"))
    assert sorted((r["publication_id"], r["line_number"], r["line"], r["active_page"], r["page_before"]) for r in plain.collect()) == want


def test_next_line_and_intervals_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(structure, "BUCKET", 5)
    rng = random.Random(4)
    points = [(rng.choice("ab"), rng.randint(1, 60), i) for i in range(50)]
    targets = [(rng.choice("ab"), rng.randint(1, 50)) for _ in range(12)]
    p = spark.createDataFrame(points, "k string, line_number int, id int")
    got = {r["id"]: r["t"] for r in structure.next_line(p, spark.createDataFrame(targets, "k string, line_number int"), ["k"], "t").collect()}
    assert got == {i: min((x for q, x in targets if q == k and x >= n), default=None) for k, n, i in points}
    lines = [(k, n) for k in "ab" for n in range(1, 41)]
    spans = [(rng.choice("ab"), rng.randint(1, 45), rng.choice([None, rng.randint(1, 60)]), i) for i in range(40)]
    x = structure.lines_within(spark.createDataFrame(lines, "publication_id string, line_number int"), spark.createDataFrame(spans, "publication_id string, low int, high int, id int"))
    assert sorted((r["id"], r["line_number"]) for r in x.collect()) == sorted((i, n) for k, lo, hi, i in spans for q, n in lines if q == k and lo <= n <= (40 if hi is None else hi))


def test_normalized_text(spark):
    rows = ["Cafe\u0301 \t uno  \r\nque si-\nguio\u0301  aquí\n\nI. Punto\nmás\u2003texto", " \n \n", "", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    got = [r["n"] for r in df.select("i", T.normalize(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == ["Café uno que siguió aquí\n\nI. Punto\nmás texto\n", "", "", None]


def test_paths(spark):
    x = spark.createDataFrame([("p", "/top/raw/p.txt", "/other/q.txt")], "p string, a string, b string")
    r = x.select(T.expected_path(F.col("p"), "/top/raw/", ".txt"), T.relative_path(F.col("a"), "/top"), T.relative_path(F.col("b"), "/top"), T.runtime_path(F.col("b"), "/top"), T.runtime_path(F.col("a"), "/top"), T.page_header(F.lit(3))).first()
    assert list(r) == ["/top/raw/p.txt", "raw/p.txt", "/other/q.txt", "external:q.txt", "raw/p.txt", "===== PDF_PAGE 3 ====="]
