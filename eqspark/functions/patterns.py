"""Patterns, word lists, tables and names of the extraction rules, in Java's regular-expression dialect.

``(?U)`` makes classes Unicode-aware and ``(?d)`` leaves line feed as the only line end; white space
also has the separators U+001C to U+001F, which Java's class lacks.
"""

#: All white space; the blank comes first.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
S = f"[{SPACES}]"

# They must be these for right results.
LABEL = rf"[A-Za-z]?{S}*\d+(?:\.\d+)?{S}*[a-z]?"
TRAILING_LABEL = rf"(?Ud)(?<![\w.])\({S}*({LABEL}){S}*\){S}*$"
TAG = r"\\tag\{([^{}]+)\}"
SPACED_LABEL = rf"(?Ud)\({S}*({LABEL}){S}*\)"
EMBEDDED_LABEL = rf"(?Ud)(?:\\quad|,|\\{S}+){S}*(?:\\left{S}*)?\({S}*({LABEL}){S}*(?:\\right{S}*)?\)"
PROSE_REFERENCE = rf"(?Ud)\b[Ee]q\.?{S}*\(?{S}*([1-9]\d*(?:\.\d+)?[a-z]?){S}*\)?"
DECIMAL_REFERENCE = rf"(?Ud)\({S}*([1-9]\d?\.\d{{1,3}}){S}*\)"
MATH_SIGNAL = r"(?Ud)(\\[A-Za-z]+|[=+\-*/^_<>]|[∑∫√≤≥≠≈∞∂∇α-ωΑ-Ω]|\b(?:psi|phi|rho|sigma|lambda|omega|theta|hat|ket|bra)\b)"
STRONG_SIGNAL = (
    r"(?Ud)(=|:=|\\(?:frac|sum|int|prod|lim|begin\{(?:array|matrix|pmatrix|bmatrix)|le|ge|neq|approx|in|to|rightarrow|leftarrow)\b|"
    rf"[≤≥≠≈∑∫∏→←]|\b(?:lim|arg{S}*min|arg{S}*max)\b)"
)
PROSE_STOP = (
    r"(?Udiu)\b(?:according|ancilla|figure|implementation|resulting|controlled|respectively|"
    r"where|describes|represents|shown|given|using|between|register)\b"
)
FRAGMENT_STOP = r"(?Udiu)\b(?:Eq|Fig|where|giving|respectively|represents|describes)\b"
CITATION = rf"(?Ud)\[\d+(?:,{S}*\d+)*\]"
LONG_WORD = r"(?Ud)\b[a-zA-Z]{4,}\b"
MATH_MARK = r"[=+\-*/^_()|⟨⟩∑∫√≤≥≠≈∞∂∇α-ωΑ-Ω]"
STRONG_MARK = r"[=+*/^_|⟨⟩∑∫√≤≥≠≈∞∂∇α-ωΑ-Ω]"
USABLE_MARK = r"[=+\-*/^_<>|⟨⟩∑∫√≤≥≠≈∞∂∇α-ωΑ-Ω]"
ONLY_MATH = rf"(?Ud)\A[\w\s\x1c-\x1f\\{{}}()\[\].,|+\-*/^_=<>⟨⟩∑∫√≤≥≠≈∞∂∇α-ωΑ-Ω]+\z"
SHORT_CONTENT = r"(?Ud)[\w\d|()\[\]{}+\-*/^_=<>⟨⟩α-ωΑ-Ω]"
PAGE_LABEL_LINE = rf"(?Ud)^{S}*\({S}*([1-9]\d*(?:\.\d+)?[a-z]?){S}*\){S}*$"
PAGE_TRAILING_LABEL = rf"(?Ud)\({S}*([1-9]\d*(?:\.\d+)?[a-z]?){S}*\){S}*$"
MAIN_LABEL = r"(?U)\A[1-9]\d*(?:\.\d+)?\z"
CONTAMINATION = r"(?Udiu)\b(?:where|Megahertz|cients|coeffi|respectively|Fig)\b"
DEGRADATION = rf"(?Ud)\b(?:X{S}+[a-z]|ħ\(|\d+i\\beta|\\kappaT LS|\\sqrt\\[A-Za-z])"
ARRAY_HEAD = rf"(?Ud)^{S}*\{{{S}*(?:[A-Za-z]{S}+){{1,}}[A-Za-z]{S}*\}}{S}*&"
#: Replaced one after the other, in this order.
GLYPHS = (
    ("α", r"\alpha"), ("β", r"\beta"), ("γ", r"\gamma"), ("δ", r"\delta"), ("ε", r"\varepsilon"), ("κ", r"\kappa"), ("λ", r"\lambda"),
    ("π", r"\pi"), ("ω", r"\omega"), ("ℏ", r"\hbar"), ("∆", r"\Delta"), ("∗", r"^*"), ("⟨", r"\langle "), ("⟩", r" \rangle"), ("−", "-"),
    ("·", r"\cdot"), ("√", r"\sqrt"), ("Σ", r"\sum"), ("∑", r"\sum"), ("ˆ", r"\hat "), ("˙", r"\dot "), ("∂", r"\partial "), ("∇", r"\nabla "),
    ("≤", r"\le "), ("≥", r"\ge "), ("≠", r"\ne "), ("≈", r"\approx "), ("∞", r"\infty "),
)
#: Cleaning rules of the reported form, in this order: pattern, replacement, whether white space goes from the ends after it.
OUTPUT_RULES = (
    (rf"^\\begin\{{array\}}{S}*\{{[^{{}}]*\}}{S}*(.*?){S}*\\end\{{array\}}$", "$1", True),
    (rf"^\{{{S}*(?:[A-Za-z]{S}+){{1,}}[A-Za-z]{S}*\}}{S}*&{S}*", "", True),
    (rf"\\mathbf{S}*\{{{S}*i{S}*\}}", r"\\mathrm{i}", False),
    (rf"\\mathbf{S}+i\b", r"\\mathrm{i}", False),
    (rf"(?:\\quad|\\qquad|\\,|\;|\\:|{S})+$", "", True),
    (rf"(?:\\{S}*){{2,}}$", "", True),
    (rf"(?<!\\)[,.]{S}*$", "", True),
    (rf"\\frac{S}*\{{{S}*([^{{}}]+?){S}*\}}{S}*\{{{S}*([^{{}}]+?){S}*\}}", r"\\frac{$1}{$2}", False),
    (rf"\{{{S}+\}}", "{}", False),
    (rf"\{{{S}*([^{{}}]+?){S}*\}}", "{$1}", False),
    (rf"_{S}*\{{{S}*([^{{}}]+?){S}*\}}", "_{$1}", False),
    (rf"\^{S}*\{{{S}*([^{{}}]+?){S}*\}}", "^{$1}", False),
    (rf"{S}+([_^])", "$1", False),
    (rf"([_^]){S}+", "$1", False),
    (rf"\\([A-Za-z]+){S}+(?=\{{)", r"\\$1", False),
    (rf"{S}+", " ", True),
    (rf"(?:\\quad|\\qquad|\\,|\;|\\:|\\{S}*)+$", "", True),
)
LABEL_WITH_LETTER, LABEL_WITH_LETTERS_BEHIND = r"(?U)\A[A-Za-z]\d+", r"(?U)\A\d+[A-Za-z]+"
CLOSING = r"(\$\$|\\\]|```)\z"
MATH_BLOCK, NUMBERED_LINE, NEIGHBOR = "docling_markdown_math_block", "docling_markdown_numbered_line", "docling_markdown_neighbor_reference"
PAGE_TEXT, PAGE_RETRY = "pymupdf_text_fallback", "docling_page_retry_math_block"
ALTERNATIVE = {MATH_BLOCK: "pix2text_markdown_math_block", NUMBERED_LINE: "pix2text_markdown_numbered_line", NEIGHBOR: "pix2text_markdown_neighbor_reference"}
LINE_LIMIT, CONTEXT_LIMIT, CONTEXT_RADIUS, REFERENCE_RADIUS, PAGE_WINDOW = 500, 500, 2, 4, 15
EQUATIONS_A_DOCUMENT, EQUATIONS_A_PAGE, ALTERNATIVE_PAGES = 200, 20, 8
DEVICE_PAGES, DEVICE_MB = 10, 20.0
