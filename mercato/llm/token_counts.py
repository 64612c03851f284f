"""Token counts by a compiled finite-state tokenizer.

A byte-pair encoding is decided by neighbours: a token sequence is the encoding of its
text exactly if every two adjacent tokens are the encoding of theirs, because merges
inside a token don't depend on what lies beyond the next boundary. Hence every prefix
of a text has one last token, and what a tokenizer must remember of a prefix is finite:
for each recent position where a vocabulary token may still be growing, its place in the
vocabulary's prefix tree, the last token before it and how many tokens lie there. These
are the states of a deterministic transducer, whose transitions carry the change in the
number of tokens. States are compiled when first reached.

A text is cut into chunks. The state map of a chunk leads from the token that crosses or
touches its left cut to those that may do so at its right cut, with the tokens emitted in
between; maps compose associatively, so those of a text are combined by a prefix scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.shared import read, small, text_of, tokenizer_path

SPACE = "▁"  # how the vocabulary writes a space
START = ""  # no token before: the start of a text, a word, or after an unknown character

# The last entry of a state is the place just read; this one says that no token ends there.
NOWHERE = (-1, START, 0)

# (overhang beyond the cut, token) on the left, the same on the right, tokens emitted
Link = tuple[int, str, int, str, int]


class Transducer:
    """Counts tokens of one word-internal run of characters; see the module's text."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.known = {c for piece in scores for c in piece}
        self.longest = max(map(len, scores), default=1)
        self._children: dict[tuple[int, str], int] = {}
        self._token: list[str | None] = [None]
        for piece in [*scores, *self.known]:
            self._insert(piece)
        self._valid: dict[tuple[str, str], bool] = {}
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._next: list[dict[str, tuple[int, int]]] = []
        self.start = self.after(START)

    def _insert(self, piece: str) -> None:
        at = 0
        for c in piece:
            if (at, c) not in self._children:
                self._children[at, c] = len(self._token)
                self._token.append(None)
            at = self._children[at, c]
        self._token[at] = piece

    def encode(self, text: str) -> list[str]:
        """Merge the best-scored adjacent pair, the leftmost of equals, while any is left."""
        parts = list(text)
        while True:
            best, where = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if best is None:
                return parts
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def cost(self, token: str) -> int:
        """A character outside the vocabulary costs its bytes."""
        return 1 if token in self.scores else len(token.encode())

    def _fits(self, last: str, token: str) -> bool:
        fits = self._valid.get((last, token))
        if fits is None:
            fits = self.encode(last + token) == ([last, token] if last else [token])
            self._valid[last, token] = fits
        return fits

    def _state(self, entries: tuple) -> int:
        state = self._ids.setdefault(entries, len(self._states))
        if state == len(self._states):
            self._states.append(entries)
            self._next.append({})
        return state

    def after(self, token: str) -> int:
        """The state just behind ``token``."""
        return self._state(((0, token, 0),))

    def last(self, state: int) -> str | None:
        """The last token of what was read, if a token ends here."""
        node, token, _ = self._states[state][-1]
        return token if node == 0 else None

    def step(self, state: int, char: str) -> tuple[int, int]:
        found = self._next[state].get(char)
        if found is None:
            found = self._next[state][char] = self._compile(state, char)
        return found

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        if char not in self.known:
            ended = self._states[state][-1]
            if ended[0] != 0:  # no token ends before it
                return self._state((NOWHERE,)), 0
            return self.start, len(char.encode())
        entries, here = [], None
        for node, last, count in self._states[state]:
            child = self._children.get((node, char))
            if child is not None:
                entries.append((child, last, count))
                token = self._token[child]
                if token is not None and here is None and self._fits(last, token):
                    here = (token, count + self.cost(token))
        if here is None:
            # Only after a token that the text doesn't really have.
            return self._state((*entries, NOWHERE)), 0
        token, delta = here
        return self._state((*((n, t, c - delta) for n, t, c in entries), (0, token, 0))), delta

    def run(self, state: int, text: str) -> tuple[int, int]:
        total = 0
        for char in text:
            state, delta = self.step(state, char)
            total += delta
        return state, total

    def trim(self, most: int = 200_000) -> None:
        """Forget the compiled states when there are many; they are compiled anew."""
        if len(self._states) > most:
            self._ids, self._states, self._next, self._valid = {}, [], [], {}
            self.start = self.after(START)


class TokenCounter(dict):
    """The transducer of a vocabulary file with runs it has already read, by word."""

    def __init__(self, file: str, most: int = 400_000, longest: int = 64):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        super().__init__()
        proto = sentencepiece_model_pb2.ModelProto()
        with open(tokenizer_path(file), "rb") as f:
            proto.ParseFromString(f.read())
        norm, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        scores = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        if (
            norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or not trained.byte_fallback
            or trained.model_type != trained.BPE
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)
            or any(SPACE in p.lstrip(SPACE) for p in scores)
        ):
            raise ValueError("only byte-pair vocabularies with byte fallback and no normalisation")
        self.automaton = Transducer(scores)
        self._most, self._longest = most, longest
        self._breaks = "\n" not in self.automaton.known
        self._words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def __missing__(self, word: str) -> int:
        """Tokens of a word after one space, or of a line feed and a word."""
        self.automaton.trim()
        text = word if word[:1] == "\n" else SPACE + word
        _, total = self.automaton.run(self.automaton.start, text)
        if len(word) <= self._longest:
            if len(self) >= self._most:
                self.clear()
            self[word] = total
        return total

    def whole(self, text: str) -> int:
        """Tokens of a text that starts where the transducer starts, without its first space."""
        if self._breaks and "  " not in text and " \n" not in text and SPACE not in text and (
            text[:1] not in ("", " ") and text[-1:] != " "
        ):  # single spaces between words: each word is a run of its own
            words = text.replace("\n", " \n").split(" ")
            if text[0] != "\n":
                return sum(map(self.__getitem__, words))
            return sum(map(self.__getitem__, words[1:])) + self[""]
        return self.spaced((SPACE + text.replace(" ", SPACE)) if text else "")

    def spaced(self, text: str) -> int:
        """Tokens of a text in the vocabulary's writing, from the transducer's start."""
        self.automaton.trim()
        total = 0
        for word in self._words.findall(text):
            total += self.automaton.run(self.automaton.start, word)[1]
        return total

    # Chunks of long texts

    def cuts(self, text: str, size: int) -> list[int]:
        """Where to cut a text in the vocabulary's writing; before a space if there is one."""
        out, at = [0], 0
        while len(text) - at > size + 4 * self.automaton.longest:
            low, high = at + 4 * self.automaton.longest, at + size
            cut = text.rfind(SPACE, low, high)
            while cut > low and text[cut - 1] == SPACE:
                cut -= 1
            at = cut if cut > low else high
            out.append(at)
        return out

    def crossing(self, text: str, cut: int) -> list[tuple[int, str]]:
        """(overhang, token) that may cross or touch the cut, going by its surroundings."""
        known, scores = self.automaton.known, self.automaton.scores
        if cut == 0 or self.clean(text, cut) or text[cut - 1] not in known:
            return [(0, START)]
        out = [] if text[cut - 1] in scores else [(0, text[cut - 1])]
        for start in range(max(0, cut - self.automaton.longest), cut):
            for end in range(cut, min(len(text), start + self.automaton.longest) + 1):
                if text[start:end] in scores:
                    out.append((end - cut, text[start:end]))
        return out

    @staticmethod
    def clean(text: str, cut: int) -> bool:
        """No token crosses the start of a run of spaces behind something else."""
        return text[cut] == SPACE and text[cut - 1] != SPACE

    def state_map(self, text: str, low: int, high: int) -> list[Link]:
        """The map of text[low:high], which lies in the whole text or in its surroundings."""
        run, step, last = self.automaton.run, self.automaton.step, self.automaton.last
        known = self.automaton.known
        exact = high == len(text) or self.clean(text, high) or text[high - 1] not in known
        out: list[Link] = []
        for over, token in self.crossing(text, low):
            if token == START and exact:
                out.append((0, START, 0, START, self.spaced(text[low:high])))
                continue
            state = self.automaton.after(token)
            state, total = run(state, text[low + over : high])
            if exact:
                if last(state) is not None:
                    out.append((over, token, 0, START, total))
                continue
            if last(state) is not None:
                out.append((over, token, 0, last(state), total))
            for end in range(high, min(len(text), high + self.automaton.longest)):
                state, delta = step(state, text[end])
                total += delta
                ended = last(state)
                if ended is not None and len(ended) > end + 1 - high:  # it crosses the cut
                    out.append((over, token, end + 1 - high, ended, total))
        return out


def compose(left: list[Link], right: list[Link]) -> list[Link]:
    """The map of two neighbouring chunks."""
    by_left: dict[tuple[int, str], list[Link]] = {}
    for link in right:
        by_left.setdefault(link[:2], []).append(link)
    return [
        (*a[:2], *b[2:4], a[4] + b[4]) for a in left for b in by_left.get((a[2], a[3]), ())
    ]


def scan(maps: list[list[Link]]) -> list[Link]:
    """Composition in pairs, so that the depth is the logarithm of the number of chunks."""
    while len(maps) > 1:
        maps = [
            compose(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i]
            for i in range(0, len(maps), 2)
        ]
    return maps[0]


LINK = "struct<over:int,token:string,to_over:int,to_token:string,n:long>"
_LINK = pa.list_(
    pa.struct(
        [("over", pa.int32()), ("token", pa.string()), ("to_over", pa.int32()),
         ("to_token", pa.string()), ("n", pa.int64())]
    )
)


def token_counts(
    docs: DataFrame, *, vocabulary: str = "piece_bpe_32k.model", limit: int = 4096,
    chunk: int = 1 << 16,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    A null or empty text has no bytes and no tokens. Repeated rows and null ids stay
    rows of their own. Texts of up to ``chunk`` characters are counted in place. Longer
    ones are cut into chunks of about that length, which are dealt to all tasks and
    counted as rows by themselves; the composed maps of a text must leave exactly one count.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in small(batches):
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([counter.whole(t) for t in texts], pa.int64())],
                schema=COUNTS,
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The surroundings of a chunk are what a token that crosses its cut can reach.
        counter = _counter(vocabulary)
        reach = counter.automaton.longest
        for batch in small(batches, 1):
            ((row, doc_id, text),) = zip(*(batch.column(i).to_pylist() for i in range(3)))
            n_bytes = len(text.encode())
            spaced = SPACE + text.replace(" ", SPACE)
            ends = counter.cuts(spaced, chunk)
            for n, (low, high) in enumerate(zip(ends, [*ends[1:], len(spaced)])):
                start = max(0, low - reach)
                around = spaced[start : high + reach]
                yield _batch([(row, doc_id, n_bytes, n, low - start, high - start, around)], CHUNKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in small(batches, 100):
            out = []
            for row, doc_id, n_bytes, part, low, high, text in zip(
                *(batch.column(i).to_pylist() for i in range(7))
            ):
                links = counter.state_map(text, low, high)
                out.append((row, doc_id, n_bytes, part, [dict(zip(LINK_NAMES, x)) for x in links]))
            yield _batch(out, MAPS)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for doc_id, n_bytes, maps in zip(*(batch.column(i).to_pylist() for i in range(3))):
                total = scan([[tuple(x[k] for k in LINK_NAMES) for x in m["map"]] for m in maps])
                if len(total) != 1:
                    raise ValueError(f"document {doc_id}: {len(total)} counts")
                out.append((doc_id, n_bytes, total[0][4]))
            yield _batch(out, COUNTS)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    counted = "doc_id long, n_bytes long, n_tokens long"
    in_place = texts.filter(F.length("text") <= chunk).mapInArrow(whole, counted)
    chunks = (
        texts.filter(F.length("text") > chunk)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(cut, "row long, doc_id long, n_bytes long, part int, low int, high int, text string")
    )
    maps = chunks.repartition("row", "part").mapInArrow(
        count, f"row long, doc_id long, n_bytes long, part int, map array<{LINK}>"
    )
    by_text = maps.groupBy("row", "doc_id", "n_bytes").agg(
        F.sort_array(F.collect_list(F.struct("part", "map"))).alias("maps")
    )
    composed = by_text.select("doc_id", "n_bytes", "maps").mapInArrow(combine, counted)
    return in_place.unionByName(composed).withColumn("over_limit", F.col("n_tokens") > limit)


LINK_NAMES = ("over", "token", "to_over", "to_token", "n")
CHUNKS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("part", pa.int32()),
     ("low", pa.int32()), ("high", pa.int32()), ("text", pa.string())]
)
MAPS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("part", pa.int32()),
     ("map", _LINK)]
)
COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(file: str) -> TokenCounter:
    """One per Python worker."""
    if file not in _COUNTERS:
        _COUNTERS[file] = TokenCounter(file)
    return _COUNTERS[file]


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
