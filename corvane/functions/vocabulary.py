"""Concept vocabulary: labels and case-insensitive patterns, in order of priority."""

# Labels and patterns decide which tags a text gets, so they can't be chosen freely.
MOTIFS: list[tuple[str, str]] = [
    ("transformation", r"\b(transform|changed? into|turned? into|shape-shift|became a)\b"),
    ("magical helper", r"\b(helped him|helped her|magic(?:al)? gift|gave him|gave her)\b"),
    ("impossible task", r"\b(impossible|three tasks?|task was|before sunrise|before night)\b"),
    ("forbidden action", r"\b(must not|forbidden|never open|do not look|should not)\b"),
    ("otherworld journey", r"\b(other world|underworld|fairy land|plain of pleasure|moon-child)\b"),
    ("enchanted sleep", r"\b(slept for|deep sleep|enchanted sleep|hundred years)\b"),
    ("lost or endangered child", r"\b(lost child|children were|child was|abandoned|stepmother)\b"),
    ("sibling rescue", r"\b(brother and sister|brothers and sisters|save (?:his|her) brother|save (?:his|her) sister)\b"),
    ("clever trick", r"\b(trick|outwit|clever|deceiv|pretend)\b"),
    ("quest", r"\b(set out|went forth|in search of|journey|adventure)\b"),
    ("royal marriage", r"\b(marry the princess|married the princess|marry the prince|became queen|became king)\b"),
    ("death and return", r"\b(came back to life|restored to life|rose from the dead|killed and)\b"),
    ("three wishes", r"\bthree wishes\b|\bthird wish\b"),
    ("magical object", r"\bmagic(?:al)? (?:ring|sword|wand|mirror|cloak|cap|stone|box|book)\b|\benchanted (?:ring|sword|mirror|object)\b"),
    ("kindness rewarded", r"\b(?:kindness|good deed).{0,50}(?:reward|fortune)|\brewarded (?:him|her|them)\b"),
    ("greed punished", r"\bgreed(?:y|iness).{0,80}(?:punish|ruin|lost)|\bpunish(?:ed|ment).{0,60}greed"),
    ("disguise", r"\bdisguis(?:e|ed|ing)\b|\bdressed (?:himself|herself) as\b"),
    ("riddle or name guessing", r"\briddles?\b|\bguess (?:my|his|her) name\b"),
    ("bargain or pact", r"\b(?:made|struck) a bargain\b|\bpromise me\b|\bin exchange for\b"),
    ("prophecy", r"\bprophes(?:y|ied)|\bforetold\b|\bit was predicted\b"),
    ("test of character", r"\bput (?:him|her|them) to the test\b|\btest (?:his|her|their) (?:heart|kindness|courage)\b"),
    ("animal spouse", r"\bmarried (?:the|a) (?:frog|bear|serpent|beast|animal)\b|\b(?:frog|bear|serpent|beast) (?:husband|wife|bridegroom|bride)\b"),
    ("monster defeat", r"\b(?:slew|killed|defeated|conquered) (?:the|a) (?:dragon|giant|ogre|monster|demon)\b"),
    ("stolen treasure", r"\bstole[n]? (?:the )?(?:gold|treasure|jewels?)\b|\bstolen treasure\b"),
    ("supernatural prohibition", r"\b(?:fairy|witch|spirit|ghost).{0,80}(?:must not|forbade|forbidden|never)\b"),
    ("miraculous birth", r"\b(?:born|birth).{0,70}(?:miracle|marvellous|wonder|peach|egg)\b"),
    ("humble hero", r"\bpoor (?:boy|girl|lad|youth|woodcutter|fisherman)\b|\byoungest son\b"),
    ("jealous sibling", r"\bjealous (?:brother|sister|brothers|sisters)\b|\b(?:brother|sister).{0,50}jealous\b"),
    ("dangerous gift", r"\b(?:gift|present).{0,80}(?:danger|death|poison|curse)|\bpoisoned (?:gift|apple|comb)\b"),
    ("rescue", r"\brescued?\b|\bsave (?:him|her|them|the princess|the prince)\b"),
    ("revenge", r"\brevenge\b|\bavenge[ds]?\b"),
    ("trickster contest", r"\bcontest\b.{0,100}\b(?:clever|trick|outwit)\b|\b(?:clever|trick|outwit).{0,100}\bcontest\b"),
    ("magical food", r"\bmagic(?:al)? (?:bean|beans|apple|fruit|food|cake|bread)\b|\benchanted (?:apple|fruit|food)\b"),
    ("flight and pursuit", r"\b(?:fled|ran away|flew away).{0,120}(?:pursu|chased|followed)\b|\b(?:pursu|chased).{0,120}(?:fled|ran away)\b"),
    ("false bride", r"\bfalse bride\b|\bwrong bride\b|\bbride was (?:changed|exchanged)\b"),
    ("recognition token", r"\b(?:ring|shoe|slipper|token).{0,80}(?:recogniz|knew her|knew him)\b"),
    ("secret room", r"\bsecret (?:room|chamber|door)\b|\bforbidden (?:room|chamber|door)\b"),
    ("homecoming", r"\breturned home\b|\bcame home at last\b|\bhome again\b"),
    ("abandoned in the forest", r"\b(?:left|abandoned|lost).{0,80}\b(?:forest|wood)\b|\bforest.{0,80}\b(?:abandoned|lost)\b"),
    ("helpful dead", r"\bdead (?:man|woman|person|father|mother).{0,100}\bhelp|\bghost.{0,80}\bhelp"),
    ("curse broken", r"\b(?:curse|spell|enchantment).{0,100}\b(?:broken|ended|lifted)\b|\bfreed from (?:the )?(?:curse|spell|enchantment)\b"),
    ("sacrifice", r"\bsacrific(?:e|ed|ing)\b|\bgave (?:his|her) life\b"),
    ("hospitality tested", r"\b(?:guest|stranger|traveller).{0,100}\b(?:food|shelter|welcome|door)\b"),
]

BEINGS: list[tuple[str, str]] = [
    ("fairy", r"\bfair(?:y|ies)\b"),
    ("witch", r"\bwitch(?:es)?\b"),
    ("giant", r"\bgiants?\b"),
    ("dragon", r"\bdragons?\b"),
    ("ogre", r"\bogres?\b"),
    ("ghost", r"\bghosts?\b"),
    ("demon", r"\bdemons?\b"),
    ("mermaid", r"\b(?:mermaids?|sea-maiden)\b"),
    ("dwarf", r"\bdwar(?:f|ves)\b"),
    ("serpent", r"\bserpents?\b"),
    ("fox", r"\bfox(?:es)?\b"),
    ("wolf", r"\bwol(?:f|ves)\b"),
    ("bear", r"\bbears?\b"),
    ("raven", r"\bravens?\b"),
    ("monkey", r"\bmonkeys?\b"),
    ("badger", r"\bbadgers?\b"),
    ("talking animal", r"\b(?:fox|wolf|bear|bird|horse|cat|dog|monkey|badger) (?:said|answered|spoke)\b"),
]

ROLES: list[tuple[str, str]] = [
    ("king", r"\bkings?\b"),
    ("queen", r"\bqueens?\b"),
    ("princess", r"\bprincess(?:es)?\b"),
    ("prince", r"\bprinces?\b"),
    ("youngest child", r"\byoungest (?:son|daughter|child|brother|sister)\b"),
    ("old woman", r"\bold wom[ae]n\b"),
    ("fisher", r"\bfisher(?:man| lad|men)?\b"),
    ("trickster", r"\btrickster\b|\boutwit\b|\bclever fox\b"),
]

CONCEPTS = {"motifs": MOTIFS, "beings": BEINGS, "roles": ROLES}
