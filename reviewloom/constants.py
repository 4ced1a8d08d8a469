"""Values that results depend on. They are data, not settings of the engine."""

# The English stop-word list used when reviews are cleaned.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Base forms of common irregular nouns and verbs; the suffix rules cover the regular ones.
IRREGULAR_LEMMAS = {
    "men": "man",
    "women": "woman",
    "children": "child",
    "feet": "foot",
    "teeth": "tooth",
    "mice": "mouse",
    "knives": "knife",
    "lives": "life",
    "leaves": "leaf",
    "bought": "buy",
    "came": "come",
    "felt": "feel",
    "found": "find",
    "gave": "give",
    "got": "get",
    "kept": "keep",
    "made": "make",
    "said": "say",
    "sent": "send",
    "took": "take",
    "thought": "think",
    "went": "go",
}

# A small polarity lexicon for reviews; callers pass their own for other domains.
POSITIVE_WORDS = """
amazing awesome best better comfortable easy enjoy excellent fantastic favorite fine glad good
great happy helpful impressed like liked love loved lovely nice perfect perfectly pleased quality
recommend recommended satisfied superb well wonderful works worth
""".split()
NEGATIVE_WORDS = """
annoying awful bad broke broken cheap damaged defective difficult disappointed disappointing fail
failed fails flimsy hard hate horrible junk poor poorly problem problems refund return returned
terrible trash ugly unhappy useless waste weak worse worst wrong
""".split()

# Words that end a conversation, and the text that introduces a product id.
EXIT_WORDS = ("exit", "quit", "bye")
ID_MARKER = "asin:"

# Answer texts.
DEFAULT_ID_QUERY = "Show reviews for ASIN"
REPEAT_ANSWER = "I already shared the review summary for ASIN: %s."
NOTHING_FOUND = "I'm sorry, I couldn't find any information for your query: '%s'"
FOUND_HEADER = "Here are some items I found for '%s':\n"
FOUND_LINE = "%d. Summary: %s | Rating: %s/5 | ASIN: %s\n"
FOUND_FOOTER = "\nWould you like more reviews or details about the author?"
NO_RECOMMENDATION = "I'm sorry, I couldn't find any products to recommend."
BEST_ITEM = "The best-rated product has a rating of %s/5. ASIN: %s. Summary: %s"
NO_REVIEWS = "I'm sorry, I couldn't find any reviews to summarize."
SUMMARIES_HEADER = "Here are the summaries for the top reviews:\n"
NO_SUMMARY = "No summary available."
NO_REVIEW_TEXT = "No review text available"
NOT_AVAILABLE = "N/A"

# Token ids with a special meaning.
PAD_ID, END_ID, UNKNOWN_ID = 0, 1, 2
