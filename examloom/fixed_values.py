"""Fixed values.

Everything in this module is data that has to equal the published data set
format exactly for results to agree: word lists, markers, limits and prompt
texts.  They are constants, listed here once in their natural order; no logic
lives in this file.
"""

# --- Fixed values: choices, labels and categories ---------------------------

NO_ANSWER_CHOICE = "정답 없음"

TOPICS = [
    "문학", "독해", "언어와 매체", "사회", "한국사", "세계사", "경제", "지리", "심리",
    "교육산업", "국제", "부동산", "생활", "책마을",
]
OTHER_TOPIC = "ETC"

PRIOR_KNOWLEDGE_NOT_NEEDED = "필요 없음"
PRIOR_KNOWLEDGE_NEEDED = "필요함"
LABEL_FAILED = "분류 실패"

AUGMENTED_ID_SUFFIX = "_aug"

# --- Fixed values: markers inside model replies and chat text ---------------

BOLD_QUESTION = "**New Question:**"
BOLD_CHOICES = "**New Choices:**"
BOLD_ANSWER = "**New Answer:**"

KO_QUESTION = "질문"
KO_QUESTION_LABEL = "질문 : "
KO_CHOICES = "선택지"
KO_ANSWER = "정답"

TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
MODEL_TURN = "<start_of_turn>model"
IGNORED = -100  # label of a token that is not trained on

# --- Fixed values: limits ----------------------------------------------------

MIN_PARAGRAPH_CHARS = 286  # a paragraph must be longer than this
MAX_TOKENS = 1024
MAX_FEATURES = 1000
MAX_ATTEMPTS = 2
OPTION_COUNT = 5
EVAL_SHARE = 0.1
SEED = 42

# --- Fixed values: word pattern of the bag-of-words features -----------------

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"

# --- Fixed values: report layout ---------------------------------------------

EPOCH_REPORT_FORMAT = (
    "Epoch : %s,\n"
    "Training Loss : %s,\n"
    "Validation Loss : %s,\n"
    "Accuracy : %s\n"
    "#########################"
)
REPORT_NUMBER_FORMAT = "%.6f"

# --- Fixed values: question prompts ------------------------------------------

SYSTEM_MESSAGE = "지문을 읽고 질문의 답을 구하세요."

PROMPT_PLAIN = """지문:
{paragraph}

질문:
{question}

선택지:
{choices}

위 선택지 번호 중 하나를 정답으로 고르세요.
정답:"""

PROMPT_WITH_MATERIAL = """지문:
{paragraph}

질문:
{question}

<보기>:
{question_plus}

선택지:
{choices}

<보기>를 참고하여 위 선택지 번호 중 하나를 정답으로 고르세요.
정답:"""

# --- Fixed values: labelling prompt ------------------------------------------

LABEL_SYSTEM_PROMPT = """
    당신은 한국 수능 문제 분석 전문가입니다. 주어진 문제를 분석하여 정확한 주제를 파악하고, 
    사전지식 필요 여부를 판단해야 합니다. 다음 지침을 따라주세요:

    1. 주제 분류: 문학, 독해, 언어와 매체, 사회, 한국사, 세계사, 경제, 지리, 심리, 
       교육산업, 국제, 부동산, 생활, 책마을 중 하나를 선택하세요.
    2. 사전지식 필요 여부: 
       - '필요 없음': 문단을 읽고 답을 유추할 수 있는 경우
       - '필요함': 문단 외의 추가적인 지식이 필요한 경우
    3. 응답 형식을 정확히 지켜주세요.

    분석 시 지문, 문제, 선택지, 보기를 모두 고려하세요.
    """

LABEL_USER_PROMPT = """
    다음 수능 문제를 분석해주세요:

    지문: {paragraph}
    문제: {question}
    선택지: {choices}
    보기: {question_plus}

    위 문제에 대해 다음 정보를 제공해주세요:
    1. 이 문제의 주제
    2. 이 문제를 풀기 위해 사전지식이 필요한지 여부 (문단만으로 답변 가능한지 고려)

    답변 형식:
    주제: [주제]
    사전지식 필요: [필요함/필요 없음]
    """

# --- Fixed values: question-generation prompt, English instructions ----------

GENERATION_EXAMPLE = """
단락: "공산주의라는 유령 하나가 유럽을 떠돌고 있다. 교황과 차르, 메테르니히와 기조, 프랑스 급진주의자와 독일 경찰 스파이를 포함한 구 유럽의 모든 강대국은 이 유령을 쫓아내고자 신성한 동맹을 맺었다. 이 사실로 두 결과가 발생한다. I. 이미 유럽 모든 강대국이 공산주의 자체가 하나의 세력임을 인정하고 있다. II. 이제 공산주의자는 전 세계에 맞서 견해, 목표, 경향을 공개 발표하고 공산당 자체 선언문으로 공산주의 유령이라는 동화에 대응해야 한다."

새로운 질문과 선택지를 생성하는 과정:
1. 단락을 읽고 주요 내용을 파악합니다.
2. 질문을 만들어 주요 내용을 테스트할 수 있도록 합니다.
3. 5개의 선택지와 그 중 정답을 만듭니다.

생성된 결과:
{
    "question": "이 글에서 공산주의에 대한 유럽 강대국들의 반응은 어떠한가?",
    "choices": [
        "공산주의를 환영하고 있다",
        "공산주의에 대해 무관심하다",
        "공산주의를 억압하려 동맹을 맺었다",
        "공산주의와 협력 관계를 맺고 있다",
        "공산주의의 존재를 부정하고 있다"
    ],
    "answer": 3
}
"""

GENERATION_PROMPT_EN = """
    Based on the given paragraph, create a multi-choice problem with 5 choices and give the correct answer. Describe the process of creating problems, options, and answers using a Chain of Thought (CoT) approach.

    Few-shot example:
    {example}

    Now, generate a question for the following paragraph:
    
    Paragraph: {paragraph}

    Original Question: {question}
    Original Choices: {choices}
    Original Answer: {answer}

    Please follow these steps:
    1. Analyze the main points of the paragraph.
    2. Consider the original question and how it relates to the paragraph.
    3. Formulate a new question that tests understanding of the paragraph in a different way.
    4. Create 5 answer choices, including the correct answer and 4 plausible distractors.
    5. Choose the "ONLY ONE" correct answer (1, 2, 3, 4, or 5).
    6. Question, Choices, Answer MUST BE Korean
    7. Provide your response just like in the following format.:
    
    New Question: [Your new question here]
    New Choices: 
    1. [Choice 1]
    2. [Choice 2]
    3. [Choice 3]
    4. [Choice 4]
    5. [Choice 5]
    New Answer: [Correct answer number]
    
    """

# --- Fixed values: question-generation prompt, Korean instructions -----------

GENERATION_SYSTEM_KO = (
    "당신은 단락과 그에 대한 예시 문제들을 참고하여 사전지식 없이 주어진 단락 내용을 읽고 "
    "추론하여 풀 수 있는 오지선다형 문제를 새롭게 생성하는 AI입니다."
)

GENERATION_USER_KO = """
        주어진 단락을 바탕으로 새로운 질문을 만들어주세요. 

        단락:
        {paragraph}

        원래 질문: {question}
        원래 선택지: {choices}
        원래 정답: {answer}

        요청 사항:
        - 한국어로 생성하며 원래 질문, 원래 선택지, 원래 정답을 참고하여 원래 내용과 다른 질문, 선택지, 정답을 생성하세요.
        - 단락의 주요 내용을 확인합니다.
        - 단락의 주요 내용을 바탕으로 원래 질문의 내용과 다른 질문을 생성합니다.
        - 5개의 선택지를 포함하되, 정답은 1개만 포함하고 대부분 선택지 5에 위치하게 생성합니다. 
        - 한국어로 작성하며, 다음 형식으로 작성합니다:

        질문: [새 질문]
        선택지:
        1. [선택지 1]
        2. [선택지 2]
        3. [선택지 3]
        4. [선택지 4]
        5. [선택지 5]
        정답: [정답 번호]

        - 이 때 정답 번호는 생성한 질문 중 정답인 선택지 번호 입니다. 
        """
