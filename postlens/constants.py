"""Word lists, tables, patterns and limits used as defaults by the operators.

Every list here is a default of a function argument; none grows with the data.
"""

# --- Fixed values: they must stay as they are for results to agree ----------

# stop words dropped before keywords are counted
KEYWORD_STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "do", "does", "did", "will", "would", "could",
    "should", "may", "might", "must", "can", "this", "that", "these", "those",
]

# terms counted as substrings, also inside longer words
TECH_KEYWORDS = [
    "ai", "artificial intelligence", "machine learning", "deep learning",
    "python", "javascript", "react", "nodejs", "docker", "kubernetes",
    "blockchain", "cryptocurrency", "cybersecurity", "iot", "cloud",
    "aws", "azure", "gcp", "devops", "api", "microservices",
]

# stop words dropped before a content hash is taken
HASH_STOP_WORDS = [
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "is", "are", "was", "were", "be", "been", "being",
]

# keywords tracked by keyword search
TRACKING_KEYWORDS = [
    "artificial intelligence", "machine learning", "deep learning",
    "data science", "python", "javascript", "react", "nodejs",
    "docker", "kubernetes", "aws", "cloud computing", "devops",
    "blockchain", "cryptocurrency", "cybersecurity", "iot",
    "startup", "tech innovation", "digital transformation",
]

# names looked for by the competition operators
COMPETITORS = ["openai", "google", "microsoft", "meta", "anthropic", "amazon"]

# hashtag categories, first match wins
HASHTAG_CATEGORIES = {
    "Programming": ["#Python", "#JavaScript", "#React", "#Programming"],
    "DevOps": ["#Docker", "#Kubernetes", "#AWS", "#DevOps"],
    "Data & AI": ["#AI", "#MachineLearning", "#DataScience"],
    "Security": ["#Cybersecurity", "#Security"],
    "Business": ["#Startup", "#Business", "#Innovation"],
    "General Tech": ["#Technology", "#Digital", "#Tech"],
}
OTHER_CATEGORY = "Other"

# keywords related to a hashtag, and those of any other hashtag
HASHTAG_KEYWORDS = {
    "#AI": ["artificial intelligence", "machine learning", "deep learning", "neural networks"],
    "#Python": ["programming", "coding", "development", "data science"],
    "#JavaScript": ["web development", "frontend", "backend", "nodejs"],
    "#React": ["frontend", "components", "jsx", "hooks"],
    "#Docker": ["containers", "devops", "deployment", "microservices"],
    "#DataScience": ["analytics", "big data", "statistics", "visualization"],
    "#Blockchain": ["cryptocurrency", "bitcoin", "ethereum", "smart contracts"],
}
DEFAULT_HASHTAG_KEYWORDS = ["technology", "innovation", "digital"]

# topic categories by substring, in order; any other topic gets the last name
TOPIC_CATEGORIES = [
    ("AI & Computing", ["ai", "machine learning", "quantum"]),
    ("Sustainability", ["sustainable", "green", "carbon"]),
    ("Developer Tools", ["no-code", "platform", "automation"]),
]
DEFAULT_TOPIC_CATEGORY = "General Technology"

# a word in front of one of these is a candidate for an emerging topic
TOPIC_HEADS = ["ai", "learning", "computing", "platform", "technology", "solution"]

# title templates by content type
TITLE_TEMPLATES = {
    "tutorial": [
        "Step-by-step guide to {topic}",
        "Beginner's tutorial: Understanding {topic}",
        "Advanced {topic} techniques for professionals",
        "Complete {topic} masterclass for developers",
        "From zero to hero: {topic} in 2024",
    ],
    "discussion": [
        "What's your experience with {topic}?",
        "Hot take: The future of {topic}",
        "Community discussion: Best practices for {topic}",
        "Debate: {topic} vs alternatives",
        "Weekly thread: Share your {topic} projects",
    ],
    "news": [
        "Breaking: Latest developments in {topic}",
        "Industry update: {topic} trends for 2024",
        "Research spotlight: New {topic} breakthrough",
        "Market analysis: {topic} adoption rates",
        "Expert opinion: Where {topic} is heading",
    ],
}

# posting slots: name, hour of day, engagement boost
POSTING_SLOTS = [
    ("weekday_morning", 9, 1.2),
    ("weekday_afternoon", 15, 1.1),
    ("weekday_evening", 19, 1.3),
    ("weekend_morning", 10, 1.0),
    ("weekend_afternoon", 14, 1.1),
]

# characters that count as white space
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
# a run of white space that is not one blank
WIDE_SPACE = rf"[\t-\r\x1c-\x1f\x85\p{{Z}}&&[^\x20]]{SPACE}*+|\x20{SPACE}++"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"
# characters that make up a word
WORD_CHAR = r"[\p{L}\p{N}_]"

# entity patterns
MENTION_PATTERN = r"@[A-Za-z0-9_]+"
HASHTAG_PATTERN = r"#[A-Za-z0-9_]+"
URL_PATTERN = r"https?://[!$-_a-z]+"
EDGE = rf"(?:(?<={WORD_CHAR})(?!{WORD_CHAR})|(?<!{WORD_CHAR})(?={WORD_CHAR}))"
EMAIL_PATTERN = EDGE + r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}" + EDGE
PHONE_PATTERN = (
    r"(\+?\p{Nd}{1,3}(?:[-.]|" + SPACE + r")?)?\(?\p{Nd}{3}\)?(?:[-.]|" + SPACE + r")?"
    r"\p{Nd}{3}(?:[-.]|" + SPACE + r")?\p{Nd}{4}"
)

# --- Defaults of our own -----------------------------------------------------

# word, polarity, subjectivity, intensity; a small general-purpose lexicon
SENTIMENT_LEXICON = [
    ("good", 0.7, 0.6, 1.0), ("great", 0.8, 0.75, 1.0), ("best", 1.0, 0.3, 1.0),
    ("better", 0.5, 0.5, 1.0), ("excellent", 1.0, 1.0, 1.0), ("amazing", 0.6, 0.9, 1.0),
    ("awesome", 1.0, 1.0, 1.0), ("love", 0.5, 0.6, 1.0), ("happy", 0.8, 1.0, 1.0),
    ("nice", 0.6, 1.0, 1.0), ("helpful", 0.5, 0.4, 1.0), ("useful", 0.3, 0.1, 1.0),
    ("easy", 0.4, 0.8, 1.0), ("fast", 0.2, 0.6, 1.0), ("win", 0.8, 0.4, 1.0),
    ("strong", 0.4, 0.7, 1.0), ("success", 0.3, 0.1, 1.0), ("innovative", 0.5, 1.0, 1.0),
    ("bad", -0.7, 0.67, 1.0), ("worst", -1.0, 1.0, 1.0), ("worse", -0.4, 0.6, 1.0),
    ("terrible", -1.0, 1.0, 1.0), ("awful", -1.0, 1.0, 1.0), ("hate", -0.8, 0.9, 1.0),
    ("sad", -0.5, 1.0, 1.0), ("poor", -0.4, 0.6, 1.0), ("slow", -0.3, 0.4, 1.0),
    ("hard", -0.3, 0.5, 1.0), ("broken", -0.4, 0.4, 1.0), ("wrong", -0.5, 0.9, 1.0),
    ("fail", -0.5, 0.3, 1.0), ("failure", -0.3, 0.3, 1.0), ("ugly", -0.7, 1.0, 1.0),
    ("boring", -1.0, 1.0, 1.0), ("useless", -0.5, 0.2, 1.0), ("dangerous", -0.6, 0.9, 1.0),
    ("very", 0.0, 0.3, 1.3), ("really", 0.0, 0.3, 1.3), ("extremely", 0.0, 1.0, 1.5),
    ("so", 0.0, 0.3, 1.2), ("slightly", 0.0, 0.2, 0.6), ("somewhat", 0.0, 0.2, 0.7),
]
NEGATIONS = ["not", "no", "never", "n't", "without"]

# frequent function words by language
LANGUAGE_PROFILES = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "was", "with", "on", "by", "are", "it", "at", "as"],
    "fr": ["le", "les", "des", "et", "du", "que", "une", "dans", "pour", "qui", "pas", "sur", "est", "au", "avec", "un"],
    "de": ["der", "die", "und", "den", "das", "nicht", "von", "sie", "ist", "des", "sich", "mit", "dem", "ein", "auf", "zu"],
    "es": ["el", "los", "que", "las", "por", "con", "una", "su", "para", "es", "al", "lo", "como", "del", "en", "y"],
}

# --- Fixed values: rows of the rule-based recommendations ---------------------

# name: type, content type, title, priority, urgency, reasoning, audience,
#       estimated engagement, hashtags, strategy, action required
# {} in a reasoning, title or estimate takes the figure the rule found
RECOMMENDATIONS = {
    "sentiment_negative": (
        "sentiment_response", "discussion", "Addressing community concerns: Let's talk", 9, "high",
        "High negative sentiment ({}) requires attention", "concerned_users", "high",
        ["#community", "#feedback", "#improvement"], "transparency_and_support", "immediate_response",
    ),
    "sentiment_positive": (
        "sentiment_amplification", "showcase", "Celebrating our amazing community achievements", 7, "medium",
        "High positive sentiment ({}) - good time to amplify", "engaged_community", "high",
        ["#celebration", "#community", "#success"], "amplify_positive_momentum", None,
    ),
    "engagement_high_activity": (
        "engagement_optimization", "discussion", "Community roundup: This week's highlights", 6, "low",
        "High community activity ({} posts) - good time for summary content", "active_community", "medium",
        ["#roundup", "#community", "#highlights"], "content_curation", None,
    ),
    "engagement_diverse_sources": (
        "content_diversity", "showcase", "Community spotlight: Diverse voices and perspectives", 5, "low",
        "Content from {} different sources shows good diversity", "general", "medium",
        ["#diversity", "#community", "#voices"], "highlight_diversity", None,
    ),
    "timing_optimal": (
        "timing_optimization", "meta", "Optimal posting time: {}:00", 4, "low",
        "Peak engagement time with {}x boost", "content_creators", "{}x normal",
        None, "timing_optimization", None,
    ),
    "content_educational": (
        "content_type", "tutorial", "Create comprehensive learning resource", 7, "medium",
        "Educational content typically performs well in tech communities", "learners", "high",
        ["#tutorial", "#learning", "#education"], "knowledge_sharing", None,
    ),
    "content_interactive": (
        "content_type", "qa", "Host interactive Q&A session", 6, "medium",
        "Interactive content drives engagement and community participation", "active_community", "very_high",
        ["#AMA", "#QA", "#interactive"], "community_engagement", None,
    ),
    "fallback_welcome": (
        "community_building", "discussion", "Welcome new community members", 5, "low",
        "Regular community building activity", "new_members", "medium",
        ["#welcome", "#community", "#newmembers"], "community_building", None,
    ),
    "fallback_tips": (
        "educational", "tutorial", "Share useful tips and tricks", 6, "low",
        "Educational content is always valuable", "general", "medium",
        ["#tips", "#tricks", "#learning"], "knowledge_sharing", None,
    ),
    "fallback_showcase": (
        "community_engagement", "showcase", "Showcase community projects", 7, "medium",
        "Highlighting community work drives engagement", "creators", "high",
        ["#showcase", "#projects", "#community"], "community_highlights", None,
    ),
}
