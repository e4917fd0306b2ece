"""Weighted finite-state transducers that read the words of a clause as symbols.

A transducer has for a state and a symbol the next state, the symbol it passes on and a
factor for the weight of what the symbol stands for. Composed transducers read one after
the other; the composition is again one machine, built before any text is read.

``PATTERN`` is passed on where a clause pattern is accepted, ``AFTER`` where a target that
follows makes a pattern of the hit before it; ``HIT`` at the end is a word by itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

# Words of the classes from SCORN on can be the end or the heart of a pattern.
(
    OTHER, BREAK, TARGET, NEGATION, REPORT, COPULA, INTENT, AFTER, PATTERN,
    SCORN, SUFFER, PURSUE, HARM, HIT,
) = range(14)
SYMBOLS = tuple(x for x in range(HIT + 1) if x != BREAK)
#: The weight of a pattern whose words have none.
ACCEPTED = 2.0

# Words that address or name a target, deny, or report what others say, and
# words of threats, in the four languages of the corpus.
TARGETS = (
    "you your yours yourself he she they them their his her him these those people "
    "du dich dir dein deine ihr euch euer sie tu te toi vous votre vos ils elles "
    "tú ti usted ustedes vosotros ellos ellas"
).split()
NEGATIONS = (
    "not no never none neither nor without isn aren wasn don doesn didn nicht kein keine "
    "keinen nie niemals ohne pas jamais aucun aucune sans ni nunca jamás ningún ninguna sin"
).split()
REPORTS = (
    "said says say called calls told wrote writes claimed quoted according allegedly "
    "sagte sagt nannte schrieb laut dit disait appelé écrit selon dijo dice llamó escribió según"
).split()
THREATS = (
    "kill murder destroy hurt beat stab shoot burn töten umbringen ermorden verletzen "
    "tuer assassiner détruire frapper matar asesinar destruir golpear"
).split()
# Words that are harmless alone: forms of to be, of the future, words that demean whom they
# are said of, what a threatened one will do, and what is done to one. Words that are common
# in another of the languages (die), or in plain sentences on paying, are left out.
COPULAS = (
    "are re is was were be been bist seid sind ist war waren es êtes est sont étais était "
    "eres son sois eran"
).split()
INTENTS = (
    "will ll shall gonna going make werde werden wirst werdet vais vas va allez allons vont "
    "voy van vamos"
).split()
SCORNS = (
    "nothing worthless useless pathetic waste trash garbage dirt joke disgrace burden vermin "
    "nichts wertlos nutzlos erbärmlich müll abfall dreck schande ungeziefer "
    "rien inutile inutiles minable minables déchet déchets ordure honte vermine "
    "nada inútil inútiles patético patéticos basura desecho vergüenza"
).split()
SUFFERS = (
    "pay regret suffer bleed bereuen büßen leiden bluten sterben "
    "regretter souffrir saigner mourir lamentar lamentarlo sufrir sangrar morir"
).split()
PURSUITS = (
    "find hunt finish bury crush ruin finden jagen kriegen vernichten begraben "
    "trouver retrouver chasser enterrer écraser encontrar cazar enterrar aplastar"
).split()


@dataclass(frozen=True)
class Transducer:
    """``steps[state, symbol] = (state, symbol passed on, factor)``; state 0 begins."""

    steps: dict[tuple[int, int], tuple[int, int, float]]

    def then(self, other: Transducer) -> Transducer:
        """The machine that passes what this one passes on to the other."""
        numbers, waiting, steps = {(0, 0): 0}, [(0, 0)], {}
        while waiting:
            pair = waiting.pop()
            for symbol in SYMBOLS:
                mine, passed, factor = self.steps[pair[0], symbol]
                theirs, final, more = other.steps[pair[1], passed]
                following = (mine, theirs)
                if following not in numbers:
                    numbers[following] = len(numbers)
                    waiting.append(following)
                steps[numbers[pair], symbol] = (numbers[following], final, factor * more)
        return Transducer(steps)


_HITS = (PATTERN, HIT)


def _window(opens: int, length: int, factor: float) -> Transducer:
    """Hits within ``length`` words of a word of the opening kind get the factor."""
    steps = {}
    for state in range(length + 1):
        for symbol in SYMBOLS:
            following = length if symbol == opens else max(state - 1, 0)
            steps[state, symbol] = (
                following, symbol, factor if symbol in _HITS and state else 1.0
            )
    return Transducer(steps)


def _rest(opens: tuple[int, ...], factor: float) -> Transducer:
    """Hits anywhere after a word of the opening kinds get the factor."""
    steps = {}
    for state in (0, 1):
        for symbol in SYMBOLS:
            following = 1 if symbol in opens else state
            steps[state, symbol] = (
                following, symbol, factor if symbol in _HITS and state else 1.0
            )
    return Transducer(steps)


def _built(begin: tuple, step: Callable[[tuple, int], tuple[tuple, int, float]]) -> Transducer:
    """The transducer whose states are those that ``step`` reaches from ``begin``."""
    numbers, waiting, steps = {begin: 0}, [begin], {}
    while waiting:
        state = waiting.pop()
        for symbol in SYMBOLS:
            following, passed, factor = step(state, symbol)
            if following not in numbers:
                numbers[following] = len(numbers)
                waiting.append(following)
            steps[numbers[state], symbol] = (numbers[following], passed, factor)
    return Transducer(steps)


def _waited(phase: tuple[str, int]) -> tuple[str, int]:
    """The phase one word later."""
    name, left = phase
    return (name, left - 1) if left > 1 else ("", 0)


def threats(aimed: float) -> Transducer:
    """Accepts a verb of harm + target, intent + verb of pursuit + target, and intent and
    target in any order + what the target will suffer, each with a few words between."""

    def step(phase, symbol):
        name = phase[0]
        if symbol == HARM:
            return ("harm", 3), HIT, 1.0
        if symbol == TARGET:
            if name == "harm":
                return ("target", 2), AFTER, aimed
            if name == "pursuit":
                return ("target", 2), PATTERN, 1.0
            return (("both", 3) if name == "intent" else ("target", 2)), TARGET, 1.0
        if symbol == INTENT:
            return (("both", 3) if name in ("target", "both") else ("intent", 3)), OTHER, 1.0
        if symbol == SUFFER:
            return (("", 0), PATTERN, 1.0) if name == "both" else (_waited(phase), OTHER, 1.0)
        if symbol == PURSUE:
            return (("pursuit", 2) if name in ("intent", "both") else _waited(phase)), OTHER, 1.0
        return _waited(phase), symbol, 1.0

    return _built(("", 0), step)


def insults(targeted: float) -> Transducer:
    """Accepts target + hit, target + copula + hit or word of scorn, hit + target, and word
    of scorn + target + copula, each with a few words between."""

    def step(state, symbol):
        (name, left), aimed = state
        later = (_waited((name, left)), aimed)
        if symbol in (TARGET, AFTER):
            if symbol == TARGET and name == "hit":
                return (("target", 3), True), AFTER, targeted
            return (("scorned" if name == "scorn" else "target", 3), True), symbol, 1.0
        if symbol == PATTERN:
            return (("", 0), True), PATTERN, 1.0
        if symbol == COPULA:
            if name == "scorned" and left == 3:
                return (("", 0), aimed), PATTERN, 1.0
            return ((("copula", 4), aimed) if name in ("target", "scorned") else later), OTHER, 1.0
        if symbol == HIT:
            if name in ("target", "copula", "scorned"):
                return later, PATTERN, 1.0
            return (later if aimed else (("hit", 4), aimed)), HIT, 1.0
        if symbol == SCORN:
            if name == "copula":
                return later, PATTERN, 1.0
            return ((("scorn", 4), aimed) if not name else later), OTHER, 1.0
        return later, symbol, 1.0

    return _built((("", 0), False), step)


@cache
def clause_grammar(
    negated: float = 0.4,
    reported: float = 0.6,
    targeted: float = 1.5,
    window: int = 3,
    aimed: float = 2.0,
) -> Transducer:
    """Threats, insults, negation, reported speech and targets, composed in this order."""
    return (
        threats(aimed)
        .then(insults(targeted))
        .then(_window(NEGATION, window, negated))
        .then(_rest((REPORT,), reported))
        .then(_rest((TARGET, AFTER, PATTERN), targeted))
    )
