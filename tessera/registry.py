"""Task registry: one row per fine-tuning task.

Everything here is data. The prompts, prefixes, label maps, sources and length
limits below are fixed values that must equal the recipes being reproduced,
so they are written out plainly, in task order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Task:
    task_id: str
    name: str
    source: str
    config: str | None
    input_col: str
    label_col: str
    prefix: str
    system_prompt: str
    label_map: dict = field(default_factory=dict)
    max_tokens: int = 512
    train_cap: int = 10000
    val_cap: int = 500
    eval_cap: int = 200


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference recipes; do not edit)
# ---------------------------------------------------------------------------
# Chat markers of the single-turn and multi-turn template.
START_USER = "<start_of_turn>user\n"
START_MODEL = "<start_of_turn>model\n"
END_TURN = "<end_of_turn>"
START_TURN = "<start_of_turn>"

# Task 01 label words.
SENTIPOLC_LABELS = {0: "negativo", 1: "positivo", 2: "neutro", -1: "neutro"}
SST2_LABELS = {0: "negativo", 1: "positivo"}
STARS_TO_SENTIMENT = {1: "negativo", 2: "negativo", 3: "neutro", 4: "positivo", 5: "positivo"}
NEUTRAL_WORD = "neutro"

# Fallback split sizes (validation, test) and the evaluation cap.
FALLBACK_VALIDATION = 100
FALLBACK_TEST = 50
FALLBACK_EVALUATION = 200

# Dry-run generic rendering and special tokens of the local BPE vocabulary.
IO_TEMPLATE_INPUT = "Input: "
IO_TEMPLATE_OUTPUT = "\nOutput: risposta"
BPE_SPECIAL_TOKENS = ["[UNK]", "[PAD]", "[EOS]", "[BOS]", "<start_of_turn>", "<end_of_turn>"]
BPE_VOCAB_SIZE = 512

TASKS: list[Task] = [
    Task("01", "sentiment_analysis", "evalitahf/sentiment_analysis", None, "text", "label", "Testo",
         "Sei un sistema di analisi del sentiment. Rispondi sempre e solo con una parola: positivo, negativo o neutro.",
         {"0": "negativo", "1": "positivo", "2": "neutro", "-1": "neutro"}, 512, 8000, 500, 200),
    Task("02", "intent", "AmazonScience/massive", "it-IT", "utt", "intent", "Utterance",
         "Sei un classificatore di intenti. Dato un utterance, rispondi con il nome esatto dell'intento.", {}, 256),
    Task("03", "topic", "fancyzhx/ag_news", None, "text", "label", "Notizia",
         "Sei un classificatore di topic. Rispondi con una sola parola: World, Sports, Business o Sci-Tech.",
         {"0": "World", "1": "Sports", "2": "Business", "3": "Sci-Tech"}, 512),
    Task("04", "nli", "MoritzLaurer/multilingual-NLI-26lang-2mil7", None, "premise", "label", "Premessa e Ipotesi",
         "Dato premessa e ipotesi, rispondi con: entailment, neutral o contradiction.",
         {"0": "entailment", "1": "neutral", "2": "contradiction"}, 512),
    Task("05", "reading_comprehension", "ehovy/race", "all", "article", "answer", "Brano, Domanda e Opzioni",
         "Leggi il brano e rispondi con la lettera dell'opzione corretta: A, B, C o D.", {}, 1024),
    Task("06", "summarization", "ARTeLab/fanpage", None, "text", "summary", "Articolo",
         "Sei un sistema di riassunto. Scrivi un riassunto conciso del seguente articolo.", {}, 2048),
    Task("07", "question_answering", "crux82/squad_it", None, "context", "answers", "Contesto e Domanda",
         "Rispondi alla domanda basandoti sul contesto fornito. Se la risposta non è nel contesto, rispondi 'Non so'.",
         {}, 1024),
    Task("08", "translation", "Helsinki-NLP/europarl-corpus", "it-en", "translation", "translation", "Testo in inglese",
         "Traduci il seguente testo in italiano in modo preciso e naturale.", {}, 512),
    Task("09", "paraphrase", "google-research-datasets/paws", "labeled_final", "sentence1", "label", "Frase originale",
         "Riscrivi la frase con parole diverse mantenendo lo stesso significato.", {}, 256),
    Task("10", "gec", "grammarly/coedit", None, "src", "tgt", "Testo con errori",
         "Correggi gli errori grammaticali nel testo preservando il significato.", {}, 512),
    Task("11", "simplification", "wiki_auto", "auto_acl", "source", "target", "Testo complesso",
         "Riscrivi il testo in modo più semplice e comprensibile, mantenendo le informazioni principali.", {}, 512),
    Task("12", "style_transfer", "s-nlp/paradetox", None, "en_toxic_comment", "en_neutral_comment", "Testo tossico",
         "Riscrivi il testo in modo neutro e non offensivo, preservando il contenuto informativo.", {}, 512),
    Task("13", "ner", "Babelscape/wikineural", "it", "tokens", "ner_tags", "Testo",
         "Esegui il riconoscimento delle entità nominate. Restituisci un JSON con lista di {testo, tipo, inizio, fine}.",
         {}, 512),
    Task("14", "relation_extraction", "thunlp/fewrel", None, "tokens", "relation", "Testo con entità marcate",
         "Estrai le relazioni tra entità dal testo. Restituisci un JSON con lista di {testa, relazione, coda}.", {}, 512),
    Task("15", "text_to_sql", "xlangai/spider", None, "question", "query", "Domanda e Schema DB",
         "Converti la domanda in linguaggio naturale in una query SQL eseguibile per lo schema fornito.", {}, 512),
    Task("16", "code_generation", "google-research-datasets/mbpp", None, "text", "code", "Specifica funzione",
         "Scrivi una funzione Python che implementa la specifica descritta. Includi solo il codice, senza spiegazioni.",
         {}, 1024),
    Task("17", "doc_classification", "fancyzhx/ag_news", None, "text", "label", "Documento",
         'Classifica il documento. Rispondi con un JSON: {"categoria": "World|Sports|Business|Sci-Tech"}.',
         {"0": "World", "1": "Sports", "2": "Business", "3": "Sci-Tech"}, 512),
    Task("18", "table_qa", "wikitablequestions", None, "question", "answers", "Tabella (Markdown) e Domanda",
         "Rispondi alla domanda basandoti sulla tabella fornita.", {}, 1024),
    Task("19", "structured_extraction", "paraloq/json_data_extraction", None, "input", "output", "Testo e Schema JSON",
         "Estrai i dati strutturati dal testo secondo lo schema JSON fornito. Restituisci solo il JSON valido.", {}, 1024),
    Task("20", "docvqa", "lmms-lab/DocVQA", None, "question", "answers", "Domanda sul documento",
         "Rispondi alla domanda basandoti sul documento/immagine fornito.", {}, 2048),
    Task("21", "sft", "mchl-labs/stambecco_data_it", None, "instruction", "output", "Istruzione",
         "", {}, 2048),
    Task("22", "multiturn_chat", "OpenAssistant/oasst1", None, "text", "text", "History conversazione",
         "Sei un assistente utile e rispettoso che risponde in italiano.", {}, 4096),
    Task("23", "rag_finetuning", "crux82/squad_it", None, "context", "answers", "Contesto recuperato e Domanda",
         "Rispondi alla domanda usando solo le informazioni nel contesto. Se la risposta non è presente, rispondi 'Non so'.",
         {}, 4096),
    Task("24", "fact_checking", "fever/fever", "v1.0", "claim", "label", "Claim ed Evidenza",
         "Verifica il claim usando l'evidenza. Rispondi con: SUPPORTS, REFUTES o NOT_ENOUGH_INFO.",
         {"0": "SUPPORTS", "1": "REFUTES", "2": "NOT_ENOUGH_INFO"}, 1024),
    Task("25", "hate_speech", "evalitahf/hatespeech_detection", None, "text", "label", "Testo",
         "Analizza il testo per rilevare linguaggio d'odio. Rispondi con: odio o non_odio.",
         {"0": "non_odio", "1": "odio"}, 256),
    Task("26", "doc_segmentation", "aharley/rvl_cdip", None, "image", "label",
         "Testo OCR pagina corrente e pagina precedente",
         "Analizza la sequenza di pagine e identifica i confini tra documenti. Usa B-DOC per inizio e I-DOC per continuazione.",
         {"0": "I-DOC", "1": "B-DOC"}, 4096),
]
# ---------------------------------------------------------------------------

_BY_ID = {t.task_id: t for t in TASKS}


def get_task(task_id: str | int) -> Task:
    key = f"{int(task_id):02d}" if str(task_id).isdigit() else str(task_id)
    if key not in _BY_ID:
        raise ValueError(f"unknown task id {task_id!r}; known: {sorted(_BY_ID)}")
    return _BY_ID[key]


REGISTRY_SCHEMA = T.StructType([
    T.StructField("task_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("config", T.StringType(), True),
    T.StructField("input_col", T.StringType(), False),
    T.StructField("label_col", T.StringType(), False),
    T.StructField("prefix", T.StringType(), False),
    T.StructField("system_prompt", T.StringType(), False),
    T.StructField("max_tokens", T.IntegerType(), False),
    T.StructField("train_cap", T.IntegerType(), False),
])


def registry_label_table(spark: SparkSession, task_id: str) -> DataFrame:
    """Label map of a task as a (code_int, code, word) table: at most a handful
    of rows, so it is safe to broadcast."""
    task = get_task(task_id)
    rows = [(int(k), str(k), v) for k, v in task.label_map.items()]
    schema = "code_int int, code string, word string"
    return spark.createDataFrame(rows, schema)
