"""Broken prompt and response pairs.

Each distilled record gets at most one defect, tested in this order: empty_answer, truncated_answer (a cut value of
``truncation``), refusal, copies_question, wrong_language. Copies are found by aligning prompt and response words: shingle
containment first, then the longest common subsequence. Refusals are found by aligning the clauses of the response with
refusal templates, with gaps. Languages are those of the classifier of ``langid``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bags, langid, truncation

_SPACE = " \t\r\n\f\v　​‌‍﻿\xa0⁠"
_NULL = {"null", "none", "nan", "nil", "n/a", "na", "undefined", "[null]", "<null>", "(null)", "<none>", "tbd", "#n/a", "空", "(空)", "（空）"}
_WRAP = re.compile(r"</?[A-Za-z_][\w\-]*\s*/?>|```\w*")
_LEADIN = re.compile(r"^(?:the\s+)?(?:final\s+)?(?:answer|response|result|conclusion|reply|output)(?:\s+is)?$|^(?:最终)?(?:答案|答|结论|回答|回复)(?:是|为|如下)?$", re.I)
_JSON_EMPTY = re.compile(r'^\{\s*"[\w ]+"\s*:\s*(?:""|null|\[\s*\]|\{\s*\})\s*(?:,\s*"[\w ]+"\s*:\s*(?:""|null|\[\s*\]|\{\s*\})\s*)*\}$', re.I)


def is_empty(text: str | None) -> bool:
    """NULL, nothing visible, only marks, an empty wrapper, a lead-in word without content, or a null-like placeholder."""
    if text is None:
        return True
    t = text.strip(_SPACE)
    if not t or _JSON_EMPTY.match(t):
        return True
    t = _WRAP.sub(" ", t).strip(_SPACE)
    if t.lower().rstrip(".。") in _NULL:
        return True
    bare = t.strip(_SPACE + "\"'“”‘’`*_#>-–—:：.。,，;；!！?？…|/\\()（）[]{}【】「」~=+^")
    return not any(ch.isalnum() for ch in bare) or bool(_LEADIN.match(bare)) or bare.lower() in _NULL


_VERBS = "assist|help|answer|provide|comply|fulfil|fulfill|complete|discuss|respond|comment|offer|produce|process|do|give|share|support|advise|take|handle"
_DE = "helfen|weiterhelfen|beantworten|antworten|erfüllen|bearbeiten|nachkommen|bereitstellen|geben|beraten"
_FR = "répondre|aider|fournir|traiter|accéder|donner|satisfaire|commenter|conseiller"
_ES = "ayudar|ayudarle|ayudarte|responder|proporcionar|cumplir|dar|ofrecer|comentar|atender"
_PT = "ajudar|ajudá|responder|fornecer|atender|cumprir|dar|oferecer|comentar"
#: Refusal templates: words that must all stand in a clause in this order; "|" parts alternatives. With each goes the number of
#: other words that may stand between them.
TEMPLATES = tuple(
    (tuple(frozenset(w.split("|")) for w in line.split()), gap)
    for gap, lines in (
        (2, f"""
i can t|not {_VERBS}
i cannot|couldn|won|wouldn {_VERBS}
i won t|be {_VERBS}
i will not {_VERBS}
i m|am unable to
i m|am not able|allowed|permitted to
i won t be able to
i will not be able to
i must|have decline
i have to decline
i respectfully|politely|must|can|will|only decline
i decline to
i refuse to
i d|would rather not
i prefer not to
my policy|policies|guidelines|rules does|do not permit|allow
against my policy|policies|guidelines|rules
as a|an language|ai model|assistant i don|do|cannot|can|won|will|am
as an ai i don|do|cannot|can|won|will|am
request|question|task falls outside what i
no answer will be given
something i m|am|cannot not|allowed|discuss
"""),
        (5, f"""
ich kann|darf|werde|möchte nicht {_DE}
kann|darf ich nicht {_DE}
ich muss ablehnen
ich lehne ab
als sprachmodell ich nicht|keine
je ne peux|puis|saurais pas {_FR}
je refuse de
je suis incapable|désolé de|mais je ne
en tant que modèle je ne
no puedo|podré|podemos {_ES}
me niego a
como modelo de lenguaje no
não posso|consigo|poderei {_PT}
recuso me a
como modelo de linguagem não
"""),
    )
    for line in lines.strip().splitlines()
)
#: Words of courtesy, which may stand before a refusal and make up clauses that say nothing.
COURTESY = frozenset(
    ("sorry apologies apologise apologize unfortunately regrettably regret but i m am we afraid that very so please understand appreciate however thank thanks you for your the this a "
     "question request asking reaching out interest hello hi dear must say to inform really truly again and well as it is "
     "es tut mir leid leider aber entschuldigung bitte danke vielen dank für ihre frage anfrage guten tag dass "
     "je suis désolé désolée mais malheureusement merci pour votre question bonjour excusez moi "
     "lo siento pero lamentablemente gracias por su tu pregunta hola disculpe lamento que "
     "sinto muito desculpe mas infelizmente obrigado obrigada pela sua pergunta olá lamento").split()
)
_ZH_REFUSAL = re.compile(
    r"^(?:(?:非常|很|十分)?(?:抱歉|对不起|遗憾|不好意思)[,，。!！]?(?:但是?)?)?(?:"
    r"我?(?:无法|不能|不便|不可以|没法)(?:为您|帮您|向您|对您|就此)?(?:回答|处理|提供|协助|帮助|完成|讨论|作答|评论|给出(?:建议|意见|答复))|"
    r"(?:根据|按照|依据)[^,，。]{0,12}(?:规范|政策|规定|准则|要求)[,，]?我(?:拒绝|不能|无法|不便)|我(?:必须|只能)?(?:拒绝|谢绝)(?:完成|回答|执行|处理|提供)?|"
    r"作为(?:一个|一名)?(?:AI|人工智能|语言模型|智能助手|助手)[^,，。]{0,8}[,，]?我?(?:不能|无法|不便|不会)|"
    r"(?:该|这个|此|您的)(?:请求|问题|任务|内容|要求)[^,，。]{0,8}(?:超出|违反|不在)[^。]{0,12}(?:范围|能力|规定|规范|政策)|"
    r"(?:这类|此类|该类|这种)(?:内容|问题|请求|任务)我(?:不能|无法|不便)|我没有(?:权限|资格|办法)(?:回答|处理|讨论|提供)|恕(?:不作答|不回答|难(?:回答|从命|奉告)|我不能))"
)
_ZH_COURTESY = re.compile(r"^(?:您好|你好|非常|很|十分)*(?:感谢|谢谢|抱歉|对不起|遗憾|不好意思|您好|你好|理解)[^,，。]{0,12}$")
_CLAUSE = re.compile(r"(?<=[.!?。！？])\s*|\n+")


def aligns(words: list[str], template: tuple[frozenset, ...], gap: int) -> bool:
    """Whether all words of the template stand in words, in order, with at most gap other words between the first and the last
    of them; what stands before the first must be courtesy. What follows the last plays no part."""
    for a, w in enumerate(words):
        if w in template[0]:
            at, left = a, gap
            for want in template[1:]:
                nxt = next((k for k in range(at + 1, min(at + 2 + left, len(words))) if words[k] in want), None)
                if nxt is None:
                    break
                left -= nxt - at - 1
                at = nxt
            else:
                return True
        if w not in COURTESY:
            return False
    return False


def is_refusal(text: str) -> bool:
    """Whether the response declines the task: the first clause that is more than courtesy aligns with a template, or the
    clauses that do make up at least half of its words. That the material lacks a figure, or that somebody else declines, is
    none."""
    said = refusing = 0
    for clause in _CLAUSE.split(text.strip()):
        bare = clause.strip(_SPACE + "\"“”。.!！?？")
        if not bare:
            continue
        ws = bags.words(bare.replace("’", " ").replace("'", " "))
        if _ZH_REFUSAL.match(bare) or any(aligns(ws, t, gap) for t, gap in TEMPLATES):
            if not said:
                return True
            refusing += len(ws)
        elif not said and (_ZH_COURTESY.match(bare) or COURTESY.issuperset(ws)):
            continue
        said += len(ws)
    return refusing > 0 and 2 * refusing >= said


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict = {}
    for i, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        m = where.get(x, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


_QLEAD = re.compile(r"^\s*(?:(?:the\s+)?(?:question|prompt|q)|问题|题目|问)\s*[:：]\s*", re.I)
_QTAIL = re.compile(r"\s*(?:(?:the\s+)?(?:final\s+)?answer|a|答案|答)\s*[:：]\s*$", re.I)


def copies_question(text: str, question: str | None) -> bool:
    """Whether the response is the question itself, perhaps slightly altered or with a lead-in word, and no answer."""
    if not question:
        return False
    a, q = bags.words(_QTAIL.sub("", _QLEAD.sub("", text))), bags.words(question)
    if len(a) < 2 or not q or len(a) > 1.25 * len(q) + 3 or len(a) < 0.7 * len(q) - 1:
        return False
    # words that a Chinese question is made of are single characters, of which longer shingles are needed
    k = 2 if len(q) < 12 else 3
    sa = {tuple(a[i : i + k]) for i in range(len(a) - k + 1)}
    sq = {tuple(q[i : i + k]) for i in range(len(q) - k + 1)}
    if len(sa & sq) < 0.35 * max(1, min(len(sa), len(sq))):
        return False
    common = lcs(a, q)
    return 2 * common >= 0.8 * (len(a) + len(q)) or bags.likeness(a, q) >= 0.85 and 2 * common >= 0.7 * (len(a) + len(q))


_NAME_ZH = re.compile(
    r"(?:公司|集团|控股|股份|银行|证券|保险|基金|市|县|区|港|省|州|物流|能源|软件|食品|药业|地产|电子|光电|传媒|纺织|矿业|化工|重工|航运|乳业|新材|环保|投资|信托)$"
)
_CJK = re.compile(f"[{bags.CJK}]")
_LATIN = re.compile(r"[^\W\d_]+")


def languages(texts: list[str | None], model: langid.Model) -> list[str | None]:
    """Language of running text: zh by its characters, others by the classifier; None for figures, letters, names and texts too
    short or too uncertain to tell."""
    out: list[str | None] = [None] * len(texts)
    ask = []
    for i, t in enumerate(texts):
        if not t:
            continue
        cjk = len(_CJK.findall(t))
        latin = sum(not _CJK.match(w) for w in _LATIN.findall(t))
        if cjk >= 2 and cjk > 1.5 * latin:
            out[i] = "zh"
        elif latin >= 3:
            ask.append(i)
    p, size = model.probabilities([texts[i] for i in ask])
    for i, k, c, n in zip(ask, p.argmax(axis=1).tolist(), p.max(axis=1, initial=0).tolist(), size.tolist()):
        if n >= langid.MIN_LETTERS and c >= langid.SURE:
            out[i] = langid.LANGUAGES[k]
    return out


_NAMED = {"english": "en", "chinese": "zh", "mandarin": "zh", "german": "de", "french": "fr", "spanish": "es", "portuguese": "pt", "英文": "en", "英语": "en", "中文": "zh", "汉语": "zh", "德语": "de", "德文": "de", "法语": "fr", "法文": "fr", "西班牙语": "es", "葡萄牙语": "pt"}
_NAMES = "english|chinese|mandarin|german|french|spanish|portuguese"
_ANY_NAME = re.compile("|".join(_NAMED), re.I)
_ASKS = (
    re.compile(rf"\b(?:answer|reply|respond|write|render|translate|put|summari[sz]e|explain|describe|state|say|express)\b[^.?!:]{{0,60}}?\b(?:in(?:to)?\s+)({_NAMES})\b", re.I),
    re.compile(rf"\b(?:answer|reply|respond|note|this|please|sentences)\b[^.?!:]{{0,30}}?\b(?:in(?:to)?\s+)({_NAMES})\b", re.I),
    re.compile(r"(?:用|以|使用|译成|翻译成|翻译为|译为)(英文|英语|中文|汉语|德语|德文|法语|法文|西班牙语|葡萄牙语)"),
)


def asked_language(question: str | None) -> str | None:
    """The language that the question asks for by name, wherever that stands; of several requests the last one holds."""
    if not question or not _ANY_NAME.search(question):
        return None
    text = " ".join(question.split())
    last = max(((m.start(1), _NAMED[m.group(1).lower()]) for p in _ASKS for m in p.finditer(text)), default=None)
    return last[1] if last else None


def wrong_language(question: str | None, answer: str | None, own: str | None, got: str | None, reasoned: str | None) -> bool:
    """own, got, reasoned: languages of question, answer and reasoning."""
    if own is None and question and len(_LATIN.findall(question)) >= 2 and not _CJK.search(question):
        own = "en"  # a short question without CJK characters; other languages of questions would show function words
    if own is None:
        return False
    want = asked_language(question) or own
    if got == "zh" and want != "zh" and len(answer) <= 30 and _NAME_ZH.search(answer.strip(_SPACE + "。.")):
        got = None  # a name
    return got is not None and got != want or (reasoned or own) != own


def plain_defect(question: str | None, answer: str | None) -> str | None:
    """Defect of a pair but for truncated answers and languages, or None."""
    if is_empty(answer):
        return "empty_answer"
    if is_refusal(answer):
        return "refusal"
    return "copies_question" if copies_question(answer, question) else None


def _defects(model: langid.Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q, a, r = (c.to_pylist() for c in batch.columns)
            got = [plain_defect(x, y) for x, y in zip(q, a)]
            rest = [i for i, d in enumerate(got) if d is None]
            of = [languages([col[i] for i in rest], model) for col in (q, a, r)]
            for i, *x in zip(rest, *of):
                if wrong_language(q[i], a[i], *x):
                    got[i] = "wrong_language"
            hit = [i for i, d in enumerate(got) if d]
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in hit], pa.string()), pa.array([got[i] for i in hit], pa.string())], ["id", "defect"])

    return run


def defective_pairs(df: DataFrame, model: langid.Model) -> DataFrame:
    """(id, defect), one row per distilled record with a defect.

    df: (id, source, question, model_answer, model_reasoning); model: the classifier of ``langid.fit``. Records whose two outputs are both NULL are not distilled;
    rows with a NULL id are ignored and rows that repeat an id count once. A NULL question is no text to copy and has no
    language. An empty df gives no rows.
    """
    rows = df.where("id is not null and (model_answer is not null or model_reasoning is not null)")
    other = rows.select(F.col("id").cast("string"), "question", "model_answer", "model_reasoning").mapInArrow(_defects(model), "id string, defect string")
    cut = truncation.cut_values(rows).where("field_name = 'model_answer'").select("id", F.lit("truncated_answer").alias("defect"))
    rank = F.when(F.col("defect") == "empty_answer", 0).when(F.col("defect") == "truncated_answer", 1).otherwise(2)
    return other.unionByName(cut).groupBy("id").agg(F.min_by("defect", rank).alias("defect"))
