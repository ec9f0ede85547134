"""Schema-compliant synthetic rows per task (S8), as column expressions of an
id column, so the generator runs on any id set Spark already has (for
example the ids of a driver table) instead of a driver-side list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s(i: Column) -> Column:
    return i.cast("string")


def _pick(i: Column, k: int, words: list[str]) -> Column:
    r = F.pmod(i, F.lit(k))
    out = F.lit(words[-1])
    for idx in range(len(words) - 2, -1, -1):
        out = F.when(r == idx, F.lit(words[idx])).otherwise(out)
    return out


def _answers(text: Column, start: int, text_first: bool = True) -> Column:
    t = F.array(text).alias("text")
    s = F.array(F.lit(start)).alias("answer_start")
    return F.struct(t, s) if text_first else F.struct(s, t)


# ---------------------------------------------------------------------------
# The synthetic row templates of the dry run, task by task.
# ---------------------------------------------------------------------------
def _templates(i: Column) -> dict[str, list[tuple[str, Column]]]:
    lit = F.lit
    return {
        "01": [("text", F.concat(lit("Questo prodotto è "), _pick(i, 3, ["ottimo", "pessimo", "nella media"]), lit("."))),
               ("label", F.pmod(i, lit(3)).cast("int"))],
        "02": [("utt", F.concat(lit("Imposta sveglia alle "), _s(7 + F.pmod(i, lit(12))), lit(" di mattina"))),
               ("intent", lit("alarm_set")), ("locale", lit("it-IT")),
               ("annot_utt", F.concat(lit("Imposta sveglia alle "), _s(7 + F.pmod(i, lit(12)))))],
        "03": [("text", F.concat(lit("Notizia di "), _pick(i, 4, ["politica", "sport", "economia", "tecnologia"]),
                                 lit(" n."), _s(i))),
               ("label", F.pmod(i, lit(4)).cast("int"))],
        "04": [("premise", lit("Il gatto dorme sul divano.")), ("hypothesis", lit("Il gatto è sul divano.")),
               ("label", lit(0))],
        "05": [("article", F.concat(lit("Testo di lettura numero "), _s(i), lit("."))),
               ("question", lit("Di cosa parla?")),
               ("options", F.array(lit("A"), lit("B"), lit("C"), lit("D"))), ("answer", lit("A"))],
        "06": [("article", F.concat(lit("Articolo lungo numero "), _s(i),
                                    lit(" con molte informazioni importanti e dettagliate su vari argomenti."))),
               ("highlights", F.concat(lit("Articolo numero "), _s(i), lit(".")))],
        "07": [("context", lit("Roma è la capitale d'Italia. Conta circa 3 milioni di abitanti.")),
               ("question", lit("Qual è la capitale d'Italia?")), ("answers", _answers(lit("Roma"), 0))],
        "08": [("en", F.concat(lit("The European Parliament met on day "), _s(i), lit("."))),
               ("it", F.concat(lit("Il Parlamento Europeo si è riunito il giorno "), _s(i), lit(".")))],
        "09": [("sentence1", lit("La banca è chiusa oggi per festività.")),
               ("sentence2", lit("Oggi la banca non è aperta.")), ("label", lit(1))],
        "10": [("incorrect", lit("Io sono andato al mercatto ieri.")),
               ("correct", lit("Io sono andato al mercato ieri."))],
        "11": [("original", lit("Il fenomeno dell'antropizzazione delle aree periurbane comporta significative "
                                "alterazioni ecosistemiche.")),
               ("simple", lit("Le città crescono e danneggiano l'ambiente."))],
        "12": [("toxic", lit("Questa persona è completamente inutile e stupida.")),
               ("neutral", lit("Non sono d'accordo con questa persona."))],
        "13": [("tokens", F.array(*[lit(x) for x in ["Mario", "Rossi", "lavora", "a", "Roma", "."]])),
               ("ner_tags", F.array(*[lit(x) for x in [1, 2, 0, 0, 3, 0]]))],
        "14": [("title", F.concat(lit("Documento "), _s(i))), ("sents", F.array(lit("Mario Rossi lavora per Fiat."))),
               ("head", lit("Mario Rossi")), ("tail", lit("Fiat")), ("relation", lit("lavoraPer"))],
        "15": [("question", lit("Quanti clienti ci sono?")), ("query", lit("SELECT COUNT(*) FROM clienti")),
               ("db_id", lit("negozio"))],
        "16": [("text", lit("Write a function that returns the sum of two numbers.")),
               ("code", lit("def somma(a, b):\n    return a + b"))],
        "17": [("text", lit("Wall St. Bears Claw Back Into the Black (Reuters). Short-sellers, Wall Street's dwindling "
                            "band of ultra-cynics, are seeing green again.")), ("label", lit(2))],
        "18": [("table", lit("| Nome | Età |\n|------|-----|\n| Mario | 30 |\n| Luca | 25 |")),
               ("question", lit("Chi è più giovane?")), ("answer", lit("Luca"))],
        "19": [("input", lit("Nome: Mario Rossi, email: mario@example.com, telefono: 333-1234567")),
               ("schema", lit('{"name": "string", "email": "string", "phone": "string"}')),
               ("output", lit('{"name": "Mario Rossi", "email": "mario@example.com", "phone": "333-1234567"}'))],
        "20": [("question", lit("Qual è il titolo del documento?")),
               ("docId", F.concat(lit("doc_"), F.lpad(_s(i), 4, "0"))),
               ("answers", _answers(F.concat(lit("Documento "), _s(i)), 0, text_first=False))],
        "21": [("instruction", lit("Scrivi una breve storia su un gatto.")), ("input", lit("")),
               ("output", lit("C'era una volta un gatto di nome Micio che viveva in una casa accogliente."))],
        "22": [("messages", F.array(
            F.struct(lit("user").alias("role"), lit("Ciao, come stai?").alias("content")),
            F.struct(lit("assistant").alias("role"), lit("Sto bene, grazie! Come posso aiutarti?").alias("content"))))],
        "23": [("question", lit("Cosa è la fotosintesi?")),
               ("context", lit("La fotosintesi è il processo con cui le piante convertono la luce solare in energia.")),
               ("answers", _answers(lit("processo"), 18))],
        "24": [("claim", lit("La terra è piatta.")),
               ("evidence", lit("Gli scienziati hanno dimostrato che la terra è sferica.")), ("label", lit(1))],
        "25": [("text", F.concat(lit("Testo di esempio numero "), _s(i), lit(" su vari argomenti sociali."))),
               ("label", lit(0))],
        "26": [("page_text", F.concat(lit("Pagina "), _s(i), lit(" del documento."))),
               ("label", F.when(F.pmod(i, lit(5)) == 0, lit("B-DOC")).otherwise(lit("I-DOC")))],
    }
# ---------------------------------------------------------------------------


def synthetic(ids: DataFrame, task_id: str, id_col: str = "i") -> DataFrame:
    """Synthetic rows of a task for every id; an unknown task id gives
    the generic one-column ``text`` row."""
    i = F.col(id_col)
    cols = _templates(i).get(task_id)
    if cols is None:
        cols = [("text", F.concat(F.lit("Esempio sintetico "), i.cast("string"), F.lit(" per task "), F.lit(task_id)))]
    return ids.select(i, *[c.alias(name) for name, c in cols])
