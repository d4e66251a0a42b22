"""Template residue and error-page text.

Every line of a record, and its whole text, is compared with three things that stand for what the record should be about:
the *slug* (the words of its source and bundle, where other corpora have an address), the *title* (its first line) and the
*body terms* of its site (the words of all ordinary lines of the same source, by document frequency). A line is low in
information and out of place where most of its terms are in none of them. Such a mismatch counts together with one of:

* *host evidence*: the line stands, word for word, in ``HOSTS`` or more bundles (the hosts);
* *learned terms*: all its terms come from responses that the host evidence has confirmed, wherever in the corpus, so that
  a variant that stands only once is found as well;
* *known terms*: the line is made only of words of one kind of notice (an error message, a demand to switch scripts on, a
  request to fill a field, filler words), or has the form of a stack trace or of one word repeated.

No word list decides alone: a listed line is residue only if the corpus says that it is out of place. *Placeholder detectors*
(patterns of unfilled template fields anywhere in a text) are the one evidence that needs no other.

Documents are scanned once, into a table of lines with their terms; all counts run over all lines of that table, whatever
their words and length, and all of it is JVM code. Lines are counted by a hash of their skeleton and combined map-side first.

Defined results
---------------
* Null, empty and blank texts are no residue. Ties cannot arise: a document is flagged or not, with every kind found.
* Repeated rows give one result per id. Empty tables give empty results. Only the named columns are read; a null host or
  site is a value of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrom import scratch
from lodestrom.functions.coordinates import let
from lodestrom.operators.joins import broadcast_if_small, fits_broadcast, skew_safe_join

# Names of HTML elements, which are no placeholders.
_HTML = "noscript|script|html|head|body|div|span|p|br|hr|a|b|i|u|em|strong|li|ul|ol|table|tr|td|th|img|h[1-6]|title|meta|link|code|pre|form|input|style|sub|sup|nav|main|section|article|footer|header|button|label|select|option|iframe|video|audio|svg|path"
# Words that stand in square brackets in ordinary text.
_MARKS = "chorus|verse|refrain|bridge|sic|note|edit|applause|laughter|music|laughs|inaudible|emphasis added|citation needed"
# Verbs and nouns with which a bracket asks to be filled in.
_ASK = "insert|enter|your|todo|tbd|add|type|fill|put|replace|name|su|ihr|ihre|ihren|votre|jou|naam|betrag|nom du|nombre|voeg|ingrese|inserte|saisir|saisissez|eingeben"
_NAME = r"[\p{L}_][\p{L}\p{N}_.:\-]*+"

#: Unfilled template fields, by form.
PLACEHOLDERS = (
    r"\{\{[^{}\n]++\}\}",
    r"\{%[^%{}\n]++%\}",
    r"[$#@%]\{[^{}\n]++\}",
    rf"\{{{_NAME}\}}",
    r"\{[0-9]{1,2}\}",
    r"<%[^%<>\n]++%>",
    r"<<[^<>\n]++>>",
    rf"<(?!/)(?!(?i:{_HTML})\b)[\p{{L}}_][\p{{L}}\p{{N}}_.\-]{{2,}}+>",
    rf"&lt;(?!/)(?!(?i:{_HTML})\b)[\p{{L}}_][\p{{L}}\p{{N}}_. \-]++&gt;",
    r"\[\[[^\[\]\n]++\]\]",
    r"\[[\p{L}][\p{L}\p{N}]*[._][\p{L}\p{N}_.]+\]",
    r"\[[\p{Ll}]+\p{Lu}[\p{L}\p{N}]*\]",
    rf"\[(?!(?i:{_MARKS})\])\p{{Lu}}[\p{{L}}\p{{N}}/]*(?:[ :/]+[\p{{L}}\p{{N}}/]+)*\]",
    rf"\[(?i:{_ASK})\b[^\[\]\n]*+\]",
    r"\((?i:insert|enter|type|fill in|todo)\b[^()\n]++\)",
    r"%\([\p{L}_][\p{L}\p{N}_.]*\)[sdif]",
    r"(?<![\p{L}\p{N}%])%[\p{L}_][\p{L}\p{N}_.]*%(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}%])%[sdif](?![\p{L}\p{N}%])",
    r"\$[\p{L}_][\p{L}\p{N}_.]*\$",
    r"@@[\p{L}_][\p{L}\p{N}_. ]*@@",
    r"##[\p{L}_][\p{L}\p{N}_. ]*##",
    r"\*\|[^|\n]++\|\*",
    r"__[\p{L}][\p{L}\p{N}.]*(?:_[\p{L}\p{N}.]+)*__",
)
# Every form begins with one of these signs: other positions of a text need no further look.
_PLACEHOLDER = r"(?=[{<&\[(%$@#*_])(?:" + "|".join(f"(?:{p})" for p in PLACEHOLDERS) + ")"

# The words of notices, per kind and language: English, German, French, Spanish, Afrikaans. Fixed values.
_COMMON = """
a an the this that these to in on of for with and or not no is are be been by your you we our it its please
der die das dieser diese dieses den dem ein eine einen und oder nicht ist sind bitte sie ihr ihre ihren ihrem in im um zu auf an es
le la les l un une ce cet cette ces de du des et ou ne pas est sont votre vos vous veuillez dans pour par plus à en s il plaît
el los las un una este esta estos y o no es son su sus en de del para por favor
die 'n n hierdie en of nie is asseblief jou u in om te vir van by
noscript page site website seite webseite página pagina sitio bladsy webwerf content inhalt contenu contenido inhoud
"""
_SCRIPTS = """
javascript js scripts script skripte skript scripten skrips
does do properly enable enabled activate activated turn switch switched allow allowed permit unblock on off disabled blocked required requires require need needs must without work works run runs
continue full view see use show display browser application app service reload refresh again then first properly
aktivieren aktiviere aktivierte aktivierten aktiviert deaktiviert schalten schalte ein einschalten lassen zulassen erlauben zu benötigt benötigen erfordert erforderlich ohne funktioniert browser laden lade neu anzuzeigen sehen fortzufahren weiter muss
activer activez activé activés autoriser autorisez autorisés désactivé désactivés requis nécessite nécessaires nécessaire sans fonctionne navigateur afficher voir continuer recharger rechargez
active activar activado activados activo permita permitir habilite habilitar habilitado desactivado desactivados requiere requieren necesita sin funciona navegador ver mostrar continuar recargue recargar vuelva cargar
skakel aan aktiveer laat toe geaktiveer vereis benodig werk sonder blaaier sien voort gaan gaan herlaai weer afgeskakel
"""
_SCRIPT_KEY = frozenset("javascript scripts skripte skripts skrips script".split())
_ERRORS = """
error errors status http code fehler erreur fout foutkode code statut estado kode
found could cannot was were has have had been moved deleted removed exist exists longer available unavailable temporarily currently
access denied permission permissions do have view forbidden unauthorized allowed
request requests could not be processed bad gateway timeout timed out too many slow down and retry try trying again later moment minutes few
something went wrong working session expired sign log in please internal server servers service resource document behind link requested requested you refused connection connect did respond time reached reach
ran into an unexpected problem occurred encountered upstream host down maintenance under overloaded go back start home page contact administrator if persists problem website unreachable invalid
wurde wurden gefunden nicht seite angeforderte angeforderten server dienst ressource dokument meldet einen internen interner fehler ist derzeit momentan erreichbar verfügbar verschoben gelöscht existiert antwortet verweigert zugriff später erneut versuchen es unerwartetes problem aufgetreten zur startseite zurück wenden administrator vorübergehend
serveur service ressource document page demandée demandé introuvable rencontré rencontre a erreur interne est momentanément indisponible n existe plus déplacé déplacée supprimé supprimée accès refusé interdit réessayer réessayez tard connexion inattendue inattendu problème trouvé trouvée temporairement revenez accueil répond
servidor servicio recurso documento página solicitada solicitado existe devolvió error interno está disponible ahora encontró encontrada encontrado acceso denegado prohibido inténtelo intente nuevo más tarde fue movido movida eliminado eliminada inesperado problema temporalmente momento respondió conexión rechazó
bediener diens hulpbron dokument bladsy wat jy soek gevind het gegee interne fout is tans onbeskikbaar beskikbaar bestaan nie toegang geweier verbode probeer later weer geskuif verwyder onverwagte probleem tydelik kon word reageer
"""
_ERROR_KEY = frozenset("""
error errors found deleted moved unavailable denied forbidden unauthorized gateway timeout expired wrong refused unexpected processed requests exist unreachable respond timed maintenance
fehler gefunden erreichbar verfügbar verschoben gelöscht verweigert existiert antwortet aufgetreten
erreur introuvable indisponible refusé interdit existe déplacé déplacée supprimé supprimée inattendu inattendue répond trouvé trouvée
disponible denegado prohibido eliminado eliminada encontrada encontrado inesperado rechazó respondió movido movida
fout gevind onbeskikbaar beskikbaar bestaan geweier verbode verwyder geskuif onverwagte reageer
""".split())
_FILLERS = """
dummy sample example placeholder filler text texts copy body paragraph headline title caption description heading subtitle summary short label name content not final replace replaced before publishing publication later here insert add enter type write put edit your box field column second first third left right section this that will go goes lorem click tap
beispieltext platzhaltertext platzhalter fülltext blindtext mustertext text überschrift titel beschreibung hier stelle dieser einfügen ergänzen eingeben ersetzen einsetzen bitte an vor veröffentlichung bildunterschrift
texte remplissage exemple remplacer titre description légende ici cadre ajoutez saisissez insérez écrivez entrez votre avant publication publier paragraphe provisoire zone
texto ejemplo relleno reemplazar título titular descripción leyenda aquí agregue escriba inserte ingrese añada publicar cuadro recuadro provisional párrafo antes
voorbeeldteks plekhouer plekhouerteks vulteks teks opskrif beskrywing titel byskrif hier tik voeg skryf sit vervang by in voor publikasie raam blokkie publiseer
"""
_FILLER_KEY = frozenset("""
dummy sample placeholder filler insert add enter type write put edit
beispieltext platzhaltertext platzhalter fülltext blindtext mustertext einfügen ergänzen eingeben ersetzen einsetzen
remplissage remplacer ajoutez saisissez insérez écrivez entrez exemple
ejemplo relleno reemplazar agregue escriba inserte ingrese añada
voorbeeldteks plekhouer plekhouerteks vulteks tik voeg skryf vervang
""".split())
_JUNK = frozenset("xxx xxxx tbd tba todo foo bar baz qux blah bla test testing dummy abc abcd asdf asdfgh qwerty qwertz jkl zzz aaa lorem na xyz sample placeholder".split())
_LATIN = frozenset("""
lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis
nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint
occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
""".split())

_WORD = re.compile(r"[^\W\d_]+")
_WORDS = {kind: sorted(set(_WORD.findall(_COMMON + words))) for kind, words in (("script_demand", _SCRIPTS), ("error_message", _ERRORS), ("filler", _FILLERS))}
_KEYS = {"script_demand": _SCRIPT_KEY, "error_message": _ERROR_KEY, "filler": _FILLER_KEY}
_LATIN_KEY = ("lorem", "ipsum", "dolor", "amet", "elit", "veniam", "nostrud", "fugiat", "aliqua", "minim", "magna")
_TRACE = r"(?i)^(?:traceback\b.*|(?:[a-z]+\.)*[a-z]*(?:error|exception): .+|at [a-z_$.]+\([a-z_]+\.java:[0-9]+\)|(?:fatal|uncaught|unhandled) (?:error|exception)\b.*)\z"
_TAG = r"(?i)</?noscript>|\b(?:request|reference|trace|incident|correlation|session|error|ray)[ _-]?id\b[ :=#]*[\w-]+"
#: Hosts in which an unknown notice must stand; a term is rare in a site's ordinary lines up to so many of them, or that share.
HOSTS, RARE_LINES, RARE = 3, 3, 0.004
#: A form of line in more than this share of a site's texts is the site's own.
OWN = 0.25
#: The share of a line's terms that must be out of place, by the evidence that it comes with.
MISMATCH = {"duplicated": 0.6, "learned": 0.5, "known": 0.25}


def placeholder(text: Column) -> Column:
    """The first unfilled field of a text; empty if there is none."""
    return F.regexp_extract(text, f"({_PLACEHOLDER})", 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _tidy(line: Column) -> Column:
    """A line without tags, request numbers and superfluous blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(line, _TAG, " "), r"\s+", " "))


def _known_kind(tidy: Column, words: Column) -> Column:
    """The kind of notice that a line looks like by its words or form, or null. This is evidence, not the verdict."""
    all_of = lambda listed: F.forall(words, lambda w: w.isin(*listed))
    any_of = lambda listed: F.exists(words, lambda w: w.isin(*listed))
    n = F.size(words)
    kind = F.when(tidy.rlike(_TRACE), "error_message")
    kind = kind.when(n == 0, None)
    kind = kind.when((n >= 4) & any_of(_LATIN_KEY) & (F.size(F.filter(words, lambda w: w.isin(*sorted(_LATIN)))) >= n * 0.9), "filler")
    kind = kind.when((n >= 2) & (all_of(sorted(_JUNK)) | ((n >= 3) & (F.size(F.array_distinct(words)) == 1))), "filler")
    for name, known in _WORDS.items():
        said = any_of(sorted(_KEYS[name])) & all_of(known)
        kind = kind.when(said & ~tidy.rlike("[0-9]") if name == "script_demand" else said, name)
    return kind


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "bundle_id", site: str = "source") -> DataFrame:
    """``doc_id, host, site, nth, field, key, terms, title, kind``: one row per line of a document (``nth`` from 0)
    and, where there are several, one for its whole text (``nth`` -1). ``field`` is the document's first placeholder."""
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), value(host).alias("host"), value(site).alias("site")).where(F.col("text").rlike(r"\S"))
    held = let(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"\S")), lambda x: F.when(F.size(x) > 1, F.concat(F.array(F.lit(None).cast("string")), x)).otherwise(F.array(F.lit(None).cast("string"))))
    each = rows.withColumn("field", placeholder(F.col("text"))).select("doc_id", "host", "site", "field", "text", (F.size(held) > 1).alias("several"), F.posexplode(held).alias("at", "line"))
    nth = F.when(F.col("several"), F.col("at") - 1).otherwise(0)
    each = each.select("doc_id", "host", "site", nth.alias("nth"), F.when(F.col("at") == 0, F.col("field")).otherwise("").alias("field"), F.coalesce("line", "text").alias("line"), F.when(F.col("at") > 1, F.regexp_extract("text", r"^\s*([^\n]*)", 1)).alias("title"))
    each = each.withColumn("tidy", _tidy(F.col("line"))).withColumn("words", _words(F.col("tidy")))
    skeleton = F.regexp_replace(F.regexp_replace(F.lower("tidy"), r"[0-9]+", "0"), r"[\s.]+", " ")
    return each.select(
        "doc_id", "host", "site", "nth", "field", F.when(F.size("words") > 0, F.unhex(F.md5(F.trim(skeleton)))).alias("key"), F.array_distinct("words").alias("terms"),
        F.when(F.col("title").isNotNull(), F.array_distinct(_words(F.col("title")))).alias("title"), _known_kind(F.col("tidy"), F.col("words")).alias("kind"),
    )


def _out_of_place(lines: DataFrame, body: DataFrame, totals: DataFrame) -> DataFrame:
    """``doc_id, nth`` with ``terms`` and ``mismatch``, the share of terms that neither slug nor title nor body terms hold."""
    term = F.explode("terms").alias("term")
    each = lines.select("doc_id", "nth", "site", "slug", "title", term).join(broadcast_if_small(totals), "site")
    place = F.concat_ws("\u0000", "site", "term").alias("place")
    each = skew_safe_join(each.select("*", place), body.select(place, "n"), "place", "left")
    rare = F.coalesce("n", F.lit(0)) < F.greatest(F.lit(float(RARE_LINES)), F.col("lines") * RARE)
    strange = rare & ~F.array_contains("slug", F.col("term")) & ~F.coalesce(F.array_contains("title", F.col("term")), F.lit(False))
    return each.groupBy("doc_id", "nth").agg(F.avg(strange.cast("double")).alias("mismatch"))


def find_residue(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "bundle_id", site: str = "source", lists: bool = True) -> DataFrame:
    """``doc_id, kind, evidence, mismatch`` of every placeholder and every line or text that is a notice.

    ``evidence`` says what else speaks against the line: ``field`` (with the placeholder as ``kind``), ``duplicated``,
    ``learned`` or ``known``; a line can have several. Without ``lists`` no word list is consulted at all.
    """
    lines = scratch.materialise(line_table(docs, doc_id, text, host, site), "residue-lines")
    fields = lines.where("field <> ''").select("doc_id", F.lit("placeholder").alias("kind"), F.lit("field").alias("evidence"), F.lit(None).cast("double").alias("mismatch"))
    named = lines.where("key is not null")
    if not lists:
        named = named.withColumn("kind", F.lit(None).cast("string"))
    totals = scratch.materialise(lines.where("nth = 0").groupBy("site").agg(F.count(F.lit(1)).alias("lines")), "site-lines")
    # a host is a bundle of a site; a form that makes up a large share of a site's texts is the site's own way to write
    forms = named.groupBy("key", "site").agg(F.count_distinct("host").alias("h"), F.count(F.lit(1)).alias("n"))
    hosts = forms.groupBy("key").agg(F.sum("h").alias("hosts")).where(F.col("hosts") >= HOSTS)
    spread = forms.join(hosts, "key").join(broadcast_if_small(totals), "site").where(F.col("n") <= F.col("lines") * OWN).select("key", "site", "hosts")
    spread = scratch.materialise(spread, "spread-lines")
    slug = F.array_distinct(F.concat(_words(F.col("site")), _words(F.col("host"))))
    # beyond the limit of a broadcast, lines of very frequent forms are joined apart from the others
    form = F.concat(F.hex("key"), "site").alias("form")
    marked = skew_safe_join(named.select("*", form), spread.select(form, "hosts"), "form", "left").drop("form").withColumn("slug", slug)
    suspect = scratch.materialise(marked.where("hosts is not null or kind is not null").select("doc_id", "nth", "host", "site", "key", "terms", "title", "slug", "kind", "hosts"), "suspect-lines")
    # body terms: of the ordinary lines only, and only those that a suspect line holds
    wanted = scratch.materialise(suspect.select(F.explode("terms").alias("term")).distinct(), "suspect-terms")
    ordinary = marked.where("hosts is null and kind is null")
    said = ordinary.where("nth >= 0").select("site", F.explode("terms").alias("term"))
    count = lambda df: df.groupBy("site", "term").agg(F.count(F.lit(1)).alias("n"))
    # few wanted terms are broadcast and filter the rows; many meet the counted terms, of which there is one a site
    body = count(said.join(F.broadcast(wanted), "term", "left_semi")) if fits_broadcast(wanted) else count(said).join(wanted, "term", "left_semi")
    body = scratch.materialise(body, "body-terms")
    judged = scratch.materialise(suspect.join(_out_of_place(suspect, body, totals), ["doc_id", "nth"]), "judged-lines")
    duplicated = judged.where(F.col("hosts").isNotNull() & (F.col("mismatch") >= MISMATCH["duplicated"]))
    known = judged.where(F.col("kind").isNotNull() & (F.col("mismatch") >= MISMATCH["known"]))
    # what the confirmed responses say: their terms, and which of these no ordinary line of the corpus holds
    everywhere = body.groupBy("term").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(totals.agg(F.sum("lines").alias("all"))))  # one row of one value
    common = everywhere.where(F.col("n") >= F.greatest(F.lit(float(RARE_LINES)), F.col("all") * RARE)).select("term", F.lit(True).alias("common"))
    heard = duplicated.select(F.explode("terms").alias("term")).distinct().join(common, "term", "left").select("term", F.col("common").isNull().alias("strange"))
    heard = scratch.materialise(heard, "learned-terms")
    each = skew_safe_join(marked.where("hosts is null").select("doc_id", "nth", F.explode("terms").alias("term")), heard, "term", "left")
    learned = each.groupBy("doc_id", "nth").agg(F.count(F.lit(1)).alias("n"), F.count("strange").alias("met"), F.count_if("strange").alias("strange"))
    learned = learned.where((F.col("met") == F.col("n")) & (F.col("strange") >= F.col("n") * MISMATCH["learned"])).withColumn("mismatch", F.col("strange") / F.col("n"))
    found = [
        duplicated.select("doc_id", F.coalesce("kind", F.lit("response")).alias("kind"), F.lit("duplicated").alias("evidence"), "mismatch"),
        known.select("doc_id", "kind", F.lit("known").alias("evidence"), "mismatch"),
        learned.select("doc_id", F.lit("response").alias("kind"), F.lit("learned").alias("evidence"), "mismatch"),
    ]
    return fields.unionByName(found[0]).unionByName(found[1]).unionByName(found[2]).distinct()
