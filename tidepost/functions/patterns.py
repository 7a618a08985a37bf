"""Regular expressions over Unicode text.

Java's own `\\w` and `\\s` cover ASCII only, so word and space characters are
spelled out.  All patterns but those with a look-ahead or a back-reference also run on RE2.
"""

# Characters that count as word, letter, digit and space.
WORD = r"\p{L}\p{N}_"
LETTER = r"\p{L}\p{Nl}\p{No}"
DIGIT = r"\p{Nd}"
SPACE = r"\t-\r\x{1C}-\x{20}\x{85}\p{Z}"

URL = rf"(?i)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
HASHTAG_BODY = rf"#([{WORD}]+)"
SPACES = rf"[{SPACE}]+"
# The same characters as SPACES; Java finds them faster in this form.
FAST_SPACES = r"(?U)[\s\x1C-\x1F]+"
EDGE_SPACES = rf"^[{SPACE}]+|[{SPACE}]+$"
NOT_WORD_OR_SPACE = rf"[^{WORD}{SPACE}]"
ANY_WORD = rf"[{WORD}]"
PLAIN_WORD = rf"[{WORD}]+"
ONLY_DIGITS = rf"^{DIGIT}+$"
# The same between white space or the ends of a text; for Java.
DIGIT_CHUNK = rf"(?U)(?<![^\s\x1C-\x1F]){DIGIT}++(?![^\s\x1C-\x1F])"
FEATURE_TOKEN = rf"[{WORD}]{{2,}}"

# What decoration removal keeps.
EMOJI_RANGES = (
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F600}-\x{1F64F}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}"
    r"\x{1F800}-\x{1F8FF}"
    r"\x{1F900}-\x{1F9FF}"
    r"\x{1FA00}-\x{1FAFF}"
    r"\x{2700}-\x{27BF}"
    r"\x{2600}-\x{26FF}"
    r"\x{200D}\x{FE0F}"
)
DECORATION = rf"[^a-zA-ZÀ-ÿ0-9{SPACE}.,!?'\-#@{EMOJI_RANGES}]"

# A run of four or more of one character other than an ASCII letter or digit.
# `\W` is a table look-up in Java, ten times faster than the ranges spelled out.
LONG_NON_ALNUM_RUN = r"([\W_])\1{3,}"
# A run of three or more of any one character.
LONG_RUN = r"(.)\1{2,}"

# Kinds of social-text token, tried in this order at each position.
_MOUTH = r"[)\](\[dp/:}{@|\\]"
_EMAIL = (
    rf"[{WORD}.+\-]+@[{WORD}\-]+\.(?:[{WORD}\-]{{2,}}(?:\.[{WORD}\-]+)*|[{WORD}\-](?:\.[{WORD}\-]+)+)"
)
_LINK = rf"https?://[^{SPACE}]*[^{SPACE}.,;:!?'\"()\[\]{{}}<>]"
# A domain name has at most 127 labels (the published limit of the name system).
_DOMAIN = r"[a-z0-9]+(?:[.\-][a-z0-9]+){0,126}\.[a-z]{2,13}"
_PHONE = rf"(?:\+?[01][ *\-.)]*)?(?:\(?{DIGIT}{{3}}[ *\-.)]*)?{DIGIT}{{3}}[ *\-.)]*{DIGIT}{{4}}"
_EMOTICON = rf"[:;=8][\-o*']?{_MOUTH}|{_MOUTH}[\-o*']?[:;=8]|<3"
_HANDLE = rf"@[{WORD}]+"
_TAG = rf"#+[{WORD}]+[{WORD}'\-]*[{WORD}]+"
_JOINED_WORD = rf"[{LETTER}][{LETTER}'\-_]+[{LETTER}]"
_NUMBER = rf"[+\-]?{DIGIT}+[,/.:\-]{DIGIT}+[+\-]?"

# The same two kinds for Java.  An e-mail address starts where its run of local characters
# starts, and a domain at the first of its labels: later starts in the same run fail as the
# first did, so looking back keeps the work linear.  Possessive repetition keeps Java from
# recursing once per label of an address.
_JAVA_EMAIL = (
    rf"(?<![{WORD}.+\-])[{WORD}.+\-]++@[{WORD}\-]++\.(?:[{WORD}\-]{{2,}}+(?:\.[{WORD}\-]++)*+|[{WORD}\-](?:\.[{WORD}\-]++)++)"
)
_JAVA_DOMAIN = r"(?<![a-z0-9])(?<![a-z0-9][.\-])[a-z0-9]++(?:[.\-][a-z0-9]++){0,126}\.[a-z]{2,13}"


def social_token(email: str, domain: str) -> str:
    """The token pattern with the given forms of address and domain."""
    kinds = [email, _LINK, domain + "/?", _PHONE, _EMOTICON, _HANDLE, _TAG, _JOINED_WORD, _NUMBER, PLAIN_WORD]
    return "(?i)" + "|".join(kinds)


# Letters up to white space, one mark or none between, are a joined or a plain word whichever
# kinds are tried before; taking them first spares most tokens those tries.
_JAVA_LETTERS = rf"[a-z{LETTER}]++(?=[.,!?]?(?![^{SPACE}]))"

SOCIAL_TOKEN = social_token(_JAVA_LETTERS + "|" + _JAVA_EMAIL, _JAVA_DOMAIN + rf"(?![{WORD}])")
# Without look-around, for RE2.
PLAIN_SOCIAL_TOKEN = social_token(_EMAIL, _DOMAIN + r"\b")
