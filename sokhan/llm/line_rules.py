"""Line-first cleaning: judge lines, drop the failing ones, then judge the document.

A line fails if it is
* navigation: at most ten words, three or more separators (| » › > / •) between
  them, or all its words from ``NAVIGATION``;
* boilerplate: holds a phrase of ``BOILERPLATE`` in lower case;
* a menu: one of ``MENU`` or more lines in a row (blank ones apart) of at most four words
  that end in no terminal punctuation; a heading alone isn't;
* badly punctuated: at least a tenth of its non-blank characters, and at least
  four, are symbols ``[#*$%&|<>]``, or at least a quarter of its words, and at
  least four, end in two or more exclamation or question marks;
* shouting and long: eight or more words, nine tenths of the letters upper case;
* a repeat of an earlier line of the document with four words or more;
* stuck: the same word five times in a row.

The two lists are of English, Spanish, French and German; the other rules know no language.
Blank lines stay. A document is rejected if its lines lose more than
``MAX_LOSS`` of its word characters, or nothing with a word is left. The base
rule (``base_failed``) is part of the verdict as the contract states it.

Null texts have no words: they fail. Repeated rows are judged alike; a text of
one very long line is judged as that line; an empty table gives no rows. Only the id and
the text are read, so other columns can't clash; the result has none of them.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sokhan.llm.common import by_batch, id_and_text, table

MAX_LOSS, MENU = 0.4, 4
NAVIGATION = frozenset(
    """home about contact login logout register sign in up menu search next previous prev back top help faq sitemap privacy terms share print skip to content
    inicio contacto entrar salir registro registrarse buscar siguiente anterior volver arriba ayuda mapa del sitio privacidad compartir imprimir
    accueil contactez connexion déconnexion inscription recherche rechercher suivant précédent retour haut aide plan du site confidentialité partager imprimer
    startseite kontakt anmelden abmelden registrieren suche suchen weiter zurück nach oben hilfe impressum datenschutz teilen drucken""".split()
)
BOILERPLATE = (
    "cookie policy", "accept cookies", "uses cookies", "all rights reserved", "terms of service", "terms of use", "privacy policy", "subscribe to our newsletter", "enable javascript", "click here", "lorem ipsum", "powered by",
    "política de cookies", "aceptar cookies", "utiliza cookies", "todos los derechos reservados", "términos de uso", "condiciones de uso", "política de privacidad", "suscríbete a nuestro boletín", "haga clic aquí",
    "politique de cookies", "accepter les cookies", "utilise des cookies", "tous droits réservés", "conditions d'utilisation", "mentions légales", "politique de confidentialité", "inscrivez-vous à notre newsletter", "cliquez ici",
    "cookie-richtlinie", "cookies akzeptieren", "verwendet cookies", "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "abonnieren sie unseren newsletter", "klicken sie hier",
)
TERMINAL = frozenset(".!?…:;。！？\"'”’»)]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
SEPARATORS = re.compile(r"[|»›>/•]")
LOUD_END = re.compile(r"[!?]{2,}$")


def failing(line: str, words: list[str], seen: set[tuple[str, ...]]) -> str | None:
    """The name of the first rule that a line fails; words are its words."""
    if not words:
        return None
    low = line.lower()
    if len(words) <= 10 and len(SEPARATORS.findall(line)) >= 3:
        return "navigation"
    bare = [b for w in low.split() if (b := w.strip(".,:|»›>/•-"))] if len(words) <= 10 else []
    if bare and all(w in NAVIGATION for w in bare):
        return "navigation"
    if any(p in low for p in BOILERPLATE):
        return "boilerplate"
    symbols = len(SYMBOLS.findall(line))
    if symbols >= 4 and 10 * symbols >= sum(map(len, words)):
        return "symbols"
    if "!!" in line or "??" in line or "!?" in line or "?!" in line:
        loud = sum(1 for w in words if LOUD_END.search(w))
        if loud >= 4 and 4 * loud >= len(words):
            return "marks"
    if len(words) >= 8 and (upper := sum(map(str.isupper, line))) >= 20 and 10 * upper >= 9 * sum(map(str.isalpha, line)):
        return "shouting"
    if len(words) >= 4 and tuple(words) in seen:
        return "repeat"
    if len(words) >= 5 and stuck(words):
        return "stuck"
    return None


def stuck(words: list[str]) -> bool:
    run, last = 0, None
    for w in words:
        run = run + 1 if w == last else 1
        last = w
        if run == 5:
            return True
    return False


def in_menus(lines: list[tuple[str, list[str]]]) -> set[int]:
    """Lines in runs of short ones without terminal punctuation."""
    out, run = set(), []
    for i, (_, words) in enumerate([*lines, (".", ["."])]):
        if 0 < len(words) <= 4 and words[-1][-1] not in TERMINAL:
            run.append(i)
        elif words:
            if len(run) >= MENU:
                out.update(run)
            run = []
    return out


def clean(text: str, max_loss: float = MAX_LOSS) -> dict:
    """The document's counts, its lines that pass, and the verdict."""
    # \x1c-\x1f and other Unicode blanks are no blanks here, so str.split() won't do.
    lines = [(line, WORD.findall(line)) for line in text.split("\n")]
    words = [w for _, ws in lines for w in ws]
    n = len(words)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeats = sum(c for c in windows.values() if c > 1)
    repeated = 0
    if repeats:
        end = 0
        for at, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
            if windows[w] > 1:
                repeated += at + 3 - max(at, end)
                end = at + 3
    kept, dropped, lost, left, exact, seen, duplicates = [], Counter(), 0, 0, set(), set(), 0
    menus = in_menus(lines) if len(lines) >= MENU else ()
    for i, (line, ws) in enumerate(lines):
        size = sum(map(len, ws))
        if ws:
            duplicates += line in exact
            exact.add(line)
        rule = failing(line, ws, seen) or ("menu" if i in menus else None)
        if ws:
            seen.add(tuple(ws))
        if rule:
            dropped[rule] += 1
            lost += size
        else:
            kept.append(line)
            left += size
    base_failed = n < 50 or 100 * repeated > 50 * n
    return {
        "n_words": n, "word_chars": lost + left, "n_symbols": len(SYMBOLS.findall(text)), "n_dup_lines": duplicates, "n_repeat_words": repeated,
        "base_failed": base_failed, "kept": not base_failed and left > 0 and lost <= max_loss * (lost + left),
        "lost_chars": lost, "n_dropped_lines": sum(dropped.values()), "rules": ",".join(sorted(dropped)), "cleaned": "\n".join(kept),
    }


_TYPES = {"n_words": ("long", pa.int64()), "word_chars": ("long", pa.int64()), "n_symbols": ("long", pa.int64()), "n_dup_lines": ("long", pa.int64()), "n_repeat_words": ("long", pa.int64()), "base_failed": ("boolean", pa.bool_()), "kept": ("boolean", pa.bool_()), "lost_chars": ("long", pa.int64()), "n_dropped_lines": ("long", pa.int64()), "rules": ("string", pa.string()), "cleaned": ("string", pa.string())}


def clean_documents(df: DataFrame, max_loss: float = MAX_LOSS, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row for each document: doc_id, the counts, the verdict and the cleaned text."""
    names = [n for n in _TYPES if with_text or n != "cleaned"]

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        found = [clean(t or "", max_loss) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id").to_pylist()} | {n: [f[n] for f in found] for n in names}

    schema = pa.schema([("doc_id", pa.int64()), *((n, _TYPES[n][1]) for n in names)])
    return by_batch(id_and_text(df, id_col, text_col), run, "doc_id long, " + ", ".join(f"{n} {_TYPES[n][0]}" for n in names), schema)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return clean_documents(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars", "n_dropped_lines", "rules")
