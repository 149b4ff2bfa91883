"""Results depend on these literals, so they are kept verbatim."""

# --- fixed values: contraction table, in matching order ---------------------
CONTRACTIONS = {
    "ain't": "am not",
    "aren't": "are not",
    "can't": "cannot",
    "can't've": "cannot have",
    "'cause": "because",
    "could've": "could have",
    "couldn't": "could not",
    "couldn't've": "could not have",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hadn't've": "had not have",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'd've": "he would have",
    "he'll": "he will",
    "he'll've": "he will have",
    "he's": "he is",
    "how'd": "how did",
    "how'd'y": "how do you",
    "how'll": "how will",
    "how's": "how is",
    "I'd": "I would",
    "I'd've": "I would have",
    "I'll": "I will",
    "I'll've": "I will have",
    "I'm": "I am",
    "I've": "I have",
    "isn't": "is not",
    "it'd": "it would",
    "it'd've": "it would have",
    "it'll": "it will",
    "it'll've": "it will have",
    "it's": "it is",
    "let's": "let us",
    "ma'am": "madam",
    "mayn't": "may not",
    "might've": "might have",
    "mightn't": "might not",
    "mightn't've": "might not have",
    "must've": "must have",
    "mustn't": "must not",
    "mustn't've": "must not have",
    "needn't": "need not",
    "needn't've": "need not have",
    "o'clock": "of the clock",
    "oughtn't": "ought not",
    "oughtn't've": "ought not have",
    "shan't": "shall not",
    "sha'n't": "shall not",
    "shan't've": "shall not have",
    "she'd": "she would",
    "she'd've": "she would have",
    "she'll": "she will",
    "she'll've": "she will have",
    "she's": "she is",
    "should've": "should have",
    "shouldn't": "should not",
    "shouldn't've": "should not have",
    "so've": "so have",
    "so's": "so is",
    "that'd": "that would",
    "that'd've": "that would have",
    "that's": "that is",
    "there'd": "there would",
    "there'd've": "there would have",
    "there's": "there is",
    "they'd": "they would",
    "they'd've": "they would have",
    "they'll": "they will",
    "they'll've": "they will have",
    "they're": "they are",
    "they've": "they have",
    "to've": "to have",
    "wasn't": "was not",
    "we'd": "we would",
    "we'd've": "we would have",
    "we'll": "we will",
    "we'll've": "we will have",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what'll": "what will",
    "what'll've": "what will have",
    "what're": "what are",
    "what's": "what is",
    "what've": "what have",
    "when's": "when is",
    "when've": "when have",
    "where'd": "where did",
    "where's": "where is",
    "where've": "where have",
    "who'll": "who will",
    "who'll've": "who will have",
    "who's": "who is",
    "who've": "who have",
    "why's": "why is",
    "why've": "why have",
    "will've": "will have",
    "won't": "will not",
    "won't've": "will not have",
    "would've": "would have",
    "wouldn't": "would not",
    "wouldn't've": "would not have",
    "y'all": "you all",
    "y'all'd": "you all would",
    "y'all'd've": "you all would have",
    "y'all're": "you all are",
    "y'all've": "you all have",
    "you'd": "you would",
    "you'd've": "you would have",
    "you'll": "you will",
    "you'll've": "you will have",
    "you're": "you are",
    "you've": "you have",
}

# --- fixed values: emoji tags ----------------------------------------------
EMOJI_TAGS_SHORT = {
    "❤️": "[HEART]",
    "🤷": "[SHRUG]",
}
EMOJI_TAGS = {
    "❤️": "[HEART]",
    "🤷": "[SHRUG]",
    "😊": "[SMILE]",
    "😢": "[CRY]",
    "👍": "[THUMBS_UP]",
    "🙏": "[THANKS]",
    "😡": "[ANGRY]",
}

# --- fixed values: intent keywords -----------------------------------------
LONG_ANSWER_KEYWORDS = ("policy", "return")
SHIPPING_KEYWORDS = ("shipping time", "delivery time", "how long")
SHIPPING_METHODS = ("Standard", "Express", "Priority", "Two-Day", "One-Day")
CLOSING_WORDS = ("quit", "exit", "bye")

# --- fixed values: prompt templates ----------------------------------------
RULES_PROMPT = (
    "You are an Amazon customer support agent. Follow these rules strictly:\n"
    "1. Answer ONLY using information from the Context below\n"
    "2. Copy relevant phrases directly from the Context\n"
    "3. After each fact, add [X] where X is the context number\n"
    "4. If the Context doesn't contain the answer, say: 'I don't have that specific information in our records.'\n"
    "5. Do NOT use external knowledge or training data\n\n"
)
OPEN_PROMPT = (
    "You are an Amazon customer support agent. The customer asked a question that is not covered in our knowledge base.\n"
    "Provide a helpful answer using your general knowledge, but start your response with:\n"
    "'I don't have specific information about this in our current database, but generally speaking...'\n\n"
)
CITE_MARK = "Support (remember to cite"
CITE_TAIL = "Support (remember to cite [X] after each fact):"
SUPPORT_TAIL = "Support:"
NO_CONTEXT = "No relevant context found."

# --- fixed values: canned answers ------------------------------------------
ANSWER_TROUBLE = "I'm sorry, I'm having trouble with that request. Could you please rephrase?"
ANSWER_UNCLEAR = "I'm sorry, my response was unclear. Could you please rephrase your question?"
ANSWER_NO_DETAIL = "I don't have detailed information about that at the moment. Could you please rephrase your question?"
ANSWER_PREFIX = "Based on our records: "
ANSWER_NO_CONTEXT_V1 = (
    "I don't have specific information about this in our current database. "
    "However, I'm here to help - could you please provide more details?"
)
ANSWER_NO_CONTEXT_V2 = (
    "I don't have specific information about this in my knowledge base. "
    "However, I'm here to help - could you please provide more details?"
)
ANSWER_GENERIC_V1 = (
    "I don't have specific information about this in our current database. "
    "Could you please provide more details or rephrase your question?"
)
ANSWER_GENERIC_V2 = (
    "I don't have specific information about this in my knowledge base. "
    "Could you please provide more details or rephrase your question?"
)
SHIPPING_LEAD = "Our shipping times are: "

# --- fixed values: thresholds ----------------------------------------------
CONTEXT_CHARS = 750
MEANINGFUL_CHARS = 50
CONTEXT_GATE = 0.5
GROUNDED_GATE = 0.6
OVERLAP_WORDS = 20
OVERLAP_CONTEXTS = 2
OVERLAP_MIN = 3
MAX_TOKENS = 512
IGNORE_LABEL = -100
HISTORY_LINES = 6

# --- regex classes that mean the same in Java regex and RE2 -----------------
# Unicode whitespace including the \x1c-\x1f separators. \p{Z} is the blanks and
# line separators from U+0020 to U+3000; single characters make one bit set in Java.
WS_BODY = r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f\x{85}\p{Z}"
# The same characters as a plain string, for trimming.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = "[" + WS_BODY + "]"
NOT_WS = "[^" + WS_BODY + "]"
WORD_BODY = r"\p{L}\p{N}_"
WORD = "[" + WORD_BODY + "]"
