"""Word lists the text functions compare against."""

# Tokens that survive cleaning but carry no topic (31 entries).
NOISE_WORDS = (
    "rt", "lt3", "lt", "gt", "amp",
    "lol", "lmao", "rofl", "lmfao", "omg",
    "haha", "hahah", "hahaha", "hahahaha",
    "hihi", "hehe", "hehehehe",
    "xx", "xxx", "xo", "xoxo",
    "ja", "nee", "oh", "ah", "uh", "hm",
    "dm", "ff", "ns", "fb",
)

# Spark ML's public English stop-word list, in its order.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
    he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
    they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
    wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
    that's there's what's when's where's who's why's would
    """.split()
)

# Spark ML's public Dutch stop-word list, in its order.
DUTCH_STOP_WORDS = tuple(
    """
    de en van ik te dat die in een hij het niet zijn is was op aan met als voor had er
    maar om hem dan zou of wat mijn men dit zo door over ze zich bij ook tot je mij uit
    der daar haar naar heb hoe heeft hebben deze u want nog zal me zij nu ge geen omdat
    iets worden toch al waren veel meer doen toen moet ben zonder kan hun dus alles onder
    ja eens hier wie werd altijd doch wordt wezen kunnen ons zelf tegen na reeds wil kon
    niets uw iemand geweest andere
    """.split()
)

STOP_WORDS_BY_LANGUAGE = {"en": ENGLISH_STOP_WORDS, "nl": DUTCH_STOP_WORDS}

# Set union, first occurrence kept.
DEFAULT_STOP_WORDS = tuple(dict.fromkeys(ENGLISH_STOP_WORDS + DUTCH_STOP_WORDS))
