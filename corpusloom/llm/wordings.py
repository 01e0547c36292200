"""What defective answers are made of: the parts from which training pairs are generated.

Every list is one kind of part. A list can be split into parts to learn from
and parts to be judged on, so that thresholds are set on wordings that the
model hasn't seen.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from zlib import crc32

# Whole answers that stand for none, and the halves of such answers.
HOLLOW = ["", " ", "　", "\n", "​", "。", "...", "…", "-", "—", "――", "*", "・", "/", "?", "???", "×", "○", "{}", "[]", "()", "「」", "```\n```", "&nbsp;", "&nbsp;&nbsp;", "<br>", "<p></p>", "<p>&nbsp;</p>", "<div></div>", "<answer></answer>", '""', "''", '{"answer": ""}', '{"answer": null}', '{"text": "", "score": null}', "A:", "A.", "Answer:", "回答:", "回答: ", "答:", "答え:", "回答:\n", "|  |", "$$", "[ ]", "xxx", "xxxx", "○○", "〇〇〇", "△△", "####"]
NOTHING = ["null", "none", "nil", "nan", "na", "n/a", "n.a.", "n. a.", "tbd", "tba", "tbc", "todo", "to do", "fixme", "wip", "unknown", "undefined", "empty", "blank", "void", "missing", "pending", "placeholder", "dummy", "test", "asdf", "lorem ipsum", "coming soon", "work in progress", "under construction", "to follow", "later", "no answer", "no answer yet", "no response", "no data", "no content", "no text", "no value", "no entry", "not available", "not applicable", "not answered", "not specified", "not provided", "not recorded", "not set", "not yet", "not yet written", "to be written", "to be determined", "to be added", "to be filled in", "left blank", "intentionally left blank", "answer goes here", "insert answer here", "your answer here", "write here", "see later", "skip", "skipped", "deleted", "removed", "none given",
           "不明", "未定", "空欄", "空白", "空", "無", "無し", "なし", "無記入", "無記載", "保留", "略", "省略", "以下略", "後述", "割愛", "欠番", "欠落", "欠損", "削除", "削除済", "同上", "ダミー", "テスト", "サンプル", "仮", "仮置き", "ブランク", "要記入", "要確認", "要追記", "要入力", "文章を入力", "ここに入力", "ここに回答", "回答をここに書く", "ここに答えを記入してください", "回答を入力してください", "あとで書く", "後で記入", "後ほど追記します", "後日追加予定です",
           "该项为空", "无", "待定", "未填写", "暂无", "暂无答案", "暂无内容", "无内容", "没有填写", "待补充", "待填写", "此处为空", "空缺", "없음", "미정", "답변 없음", "내용 없음", "작성 중", "keine angabe", "k. a.", "keine antwort", "offen", "sans réponse", "à compléter", "néant", "sin respuesta", "pendiente", "por completar", "нет ответа", "н/д", "не указано"]
_NO, _OF, _AFTER = ["未", "無"], ["回答", "記入", "入力", "記載", "設定", "登録", "作成", "確認", "対応", "掲載", "着手", "定義", "取得", "収録", "執筆", "編集", "決定", "整理", "提出", "送信"], ["", "", "です", "のまま", "項目", "欄"]
_WHAT, _LACKS = ["回答", "答え", "記載", "記入", "入力", "内容", "情報", "該当", "該当事項", "データ", "コメント", "説明", "本文", "返答", "解答", "備考", "応答", "文字", "値", "テキスト", "項目", "資料", "指定", "記述", "正解", "特記事項"], ["なし", "無し", "無", "はありません", "がありません", "待ち", "欠落", "欠如", "空欄", "省略", "未定", "未完", "予定", "は後日", "は後ほど", "は空です", "がない", "ゼロ", "なしです", "は未作成"]
_DOING, _YET = ["準備", "作成", "確認", "調査", "検討", "執筆", "編集", "入力", "翻訳", "更新", "処理", "工事", "整備", "作業", "集計", "読み込み", "生成"], ["中", "中です", "待ち", "予定", "中…", "未了", "途中"]

# Parts of refusals. {t} is a topic.
JA_FRAME = ["", "", "", "申し訳ありませんが、", "申し訳ございませんが、", "大変申し訳ございません。", "恐れ入りますが、", "恐縮ですが、", "誠に恐縮ですが、", "誠に勝手ながら、", "残念ながら、", "残念ですが、", "あいにく、", "あいにくですが、", "すみません。", "すみませんが、", "ごめんなさい。", "失礼ながら、", "お手数ですが、", "ご質問ありがとうございます。ただ、", "お問い合わせありがとうございます。しかし、", "ご質問の件ですが、", "せっかくのご質問ですが、", "回答: ", "AI として、", "AI アシスタントとして、", "言語モデルである私は、", "安全上の理由から、", "規約上、", "社内規定により、", "方針により、", "守秘義務のため、", "契約上の理由で、", "機密保持の観点から、", "立場上、", "個人情報保護のため、", "セキュリティ上の都合により、", "法令により、", "専門外のため、", "情報が不足しているため、", "資料に記載がなく、", "与えられた文章からは、", "提供された情報だけでは、", "本文に書かれていないため、", "手元に資料がないので、", "学習データに含まれないため、", "現時点では、", "機密事項につき、", "諸般の事情により、"]
JA_ABOUT = ["", "", "その件については", "その件は", "この質問には", "この質問については", "その内容については", "ご質問の点は", "この話題については", "それについては", "これ以上は", "ここでは", "この場では", "詳細は", "具体的な値は", "{t}については", "{t}に関しては", "{t}のことは", "{t}の詳細は", "{t}に関するご質問には", "{t}の具体的な値は", "{t}の話題は", "{t}の扱いは", "{t}は"]
JA_VERB = ["お答え", "回答", "返答", "ご説明", "説明", "お伝え", "お教え", "お示し", "ご案内", "開示", "公開", "公表", "提供", "ご提供", "明か", "コメント", "言及", "お話し", "判断", "断定", "特定", "確認", "推測", "把握", "対応", "助言", "お引き受け", "お手伝い", "ご紹介", "申し上げ", "議論", "評価", "お知らせ"]
JA_UNABLE = ["できません", "できません。", "できかねます", "いたしかねます", "することはできません", "することができません", "を差し控えます", "を控えさせていただきます", "を控えます", "は控えたいと思います", "することは控えます", "は遠慮いたします", "を見送ります", "を辞退します", "はお断りします", "を拒否します", "は致しません", "しないことにしています", "しかねる内容です", "するわけにはいきません", "する立場にありません", "する権限がありません", "する知識がありません", "するための情報がありません", "するだけの材料がありません", "してはならないことになっています", "は許可されていません", "は禁じられています", "は認められていません", "は不可能です", "は困難です", "不可です", "不可", "できない決まりです", "できないことになっています", "しない方針です", "の対象外です", "の範囲を超えています"]
JA_WHOLE = ["わかりません", "分かりかねます", "わかりかねます", "存じません", "存じ上げません", "知りません", "見当がつきません", "お力になれません", "お役に立てません", "扱えません", "応じられません", "お答えするのは難しいです", "答えられません", "答えたくありません", "教えられません", "言えません", "申し上げられません", "お話しできることはありません", "話すことはできません", "情報を持ち合わせておりません", "知見を持っていません", "そのような情報は手元にありません", "判断する根拠が見当たりません", "記載が見つかりません", "該当する記述がありません", "どこにも書かれていません", "非公開です", "非公開としています", "公開していません", "公表していません", "社外秘です", "機密です", "開示対象外です", "極秘扱いです", "内部情報なので出せません", "私の専門ではありません", "私の守備範囲ではありません", "私の能力を超えています", "知るすべがありません", "ノーコメントです", "ノーコメント", "ノーコメントとさせてください", "回答の対象外です", "回答は保留します", "パスします", "その質問は受け付けていません", "その質問は取り扱っておりません", "その話はご勘弁ください", "別の方に聞いてください", "ご自身でお調べください", "控えさせてください", "ご遠慮ください", "ご期待に沿えません", "何とも言えません", "何も申し上げられません", "答えは持っていません", "お答えは控えます", "回答を控えます", "回答はできません", "教えることはできません", "回答拒否", "回答不可", "開示不可", "公開不可", "説明不能", "口外できません", "秘密です", "ご容赦ください"]
JA_TAIL = ["", "", "", "", "別の質問をお願いします。", "専門家にご相談ください。", "ご了承ください。", "ご理解ください。", "何卒ご理解のほどお願いいたします。", "他にご質問はありますか?", "担当の窓口にお尋ねください。", "何か他にお手伝いできますか。", "メーカーにご確認ください。", "製造元へお問い合わせください。", "専門の資料を参照してください。", "あしからずご了承願います。", "お役に立てず申し訳ございません。", "質問を変えていただけますか。", "詳しい方に聞いてみてください。"]
EN_FRAME = ["", "", "", "I'm sorry, but ", "Sorry, ", "Unfortunately, ", "I apologize, but ", "Regrettably, ", "I'm afraid ", "Thank you for asking, but ", "As an AI, ", "As a language model, ", "Due to our policy, ", "For safety reasons, ", "For legal reasons, "]
EN_CORE = ["I can't help with that.", "I cannot answer this question.", "I can't answer that.", "I'm unable to provide that information.", "I am not able to discuss {t}.", "I won't discuss {t}.", "I will not answer that.", "that is beyond what I can discuss.", "there is no answer I can give to this.", "no answer can be given to that.", "I cannot provide details on {t}.", "I am unable to comment on {t}.", "I would prefer not to comment on {t}.", "I'd rather not say.", "this question cannot be answered.", "I must decline to answer.", "I have to decline.", "I decline to respond.", "I refuse to answer.", "please ask an expert instead.", "the document does not say, so I cannot tell.", "the text does not mention {t}.", "no information is available on this.", "no details can be shared.", "this falls outside my scope.", "that is outside my expertise.", "I don't know.", "I do not know the answer.", "I have no idea.", "I'm not sure.", "I don't have enough information to answer.", "I don't have access to that information.", "I lack the knowledge to answer.", "that information is confidential.", "this is classified.", "that is not public.", "we do not disclose {t}.", "we are not permitted to share this.", "it is against our policy to answer.", "no comment.", "No comment", "I can't say.", "I cannot tell you that.", "you will have to ask someone else.", "I'm not allowed to talk about {t}.", "I can't assist with this request.", "my guidelines prevent me from answering.", "not something I can talk about.", "we cannot respond to this inquiry.", "request denied.", "answer withheld.", "I would rather not comment on {t}.", "I prefer not to say.", "please consult the maker of {t}.", "this is something I should not discuss."]
EN_TAIL = ["", "", "", " Please consult a specialist.", " Is there anything else I can help with?", " Please contact the manufacturer.", " Please rephrase the question.", " Thank you for understanding.", " Let me know if you have another question."]
OTHER_REFUSALS = ["抱歉,我无法回答这个问题。", "对不起,我不能提供相关信息。", "很遗憾,没有足够的资料来回答。", "这个问题超出了我的能力范围。", "恕我不能透露。", "我不知道。", "无可奉告。", "无法回答。", "拒绝回答。", "该内容属于机密,不便公开。", "我不方便回答。", "根据规定,不予回答。", "不清楚,请咨询专业人员。", "作为人工智能,我无法评论{t}。",
                  "죄송하지만 이 질문에는 답변할 수 없습니다.", "죄송합니다. 알려 드릴 수 없습니다.", "모르겠습니다.", "답변을 거부합니다.", "해당 정보는 비공개입니다.", "저는 그 내용에 대해 말씀드릴 수 없습니다.", "정보가 부족하여 답변하기 어렵습니다.", "도와드릴 수 없습니다.",
                  "Leider kann ich diese Frage nicht beantworten.", "Dazu kann ich nichts sagen.", "Das weiß ich nicht.", "Ich darf darüber keine Auskunft geben.", "Es tut mir leid, dabei kann ich nicht helfen.", "Kein Kommentar.", "Je suis désolé, je ne peux pas répondre à cette question.", "Je ne sais pas.", "Je ne peux pas vous aider.", "Je préfère ne pas en parler.", "Ces informations sont confidentielles.", "Sans commentaire.",
                  "Lo siento, no puedo responder a esta pregunta.", "No lo sé.", "No puedo ayudarle con eso.", "Esa información es confidencial.", "No estoy autorizado a hablar de ello.", "Mi dispiace, non posso rispondere.", "Non lo so.", "Desculpe, não posso responder a isso.", "Não sei.", "Извините, я не могу ответить на этот вопрос.", "Я не знаю.", "Эта информация не разглашается.", "Без комментариев.", "К сожалению, я не могу помочь."]

# What frames a question that is given back. {q} is the question, {b} the same without its mark, {n} without its form.
COPIES = ["{q}", "{q}", "{b}", "質問: {q}", "質問:{q}", "問: {q}", "問い：{b}", "Question: {q}", "Q: {q}", "Q: {q}\nA: ", "Q: {q}\nA: {b}", "Q. {q}", "「{q}」", "「{b}」", "『{q}』", '"{q}"', "“{b}”", "({q})", "> {q}", "**{q}**", "{q}\n{q}", "{q} {q}", " {b} ", "回答: {q}", "A: {q}", "答え: {b}", "ご質問は次のとおりです。{q}", "ご質問は以下のとおりです。\n{q}", "ご質問は「{b}」ですね。", "ご質問は、{b}、ということですね。", "お尋ねの内容は「{q}」です。", "お尋ねは{b}ということですね。", "「{b}」というご質問ですね。", "「{q}」というお問い合わせを承りました。", "{b}についてのご質問ですね。", "{n}についてのご質問ですね。", "{n}に関するお尋ねですね。", "{n}ということですね。", "{n}を知りたいのですね。", "{n}について知りたいということですね。", "{n}について", "{n}について説明します。", "{n}についてお答えします。", "{n}が問われています。", "{n}を聞かれています。", "この質問は{n}を尋ねるものです。", "質問の内容は{n}です。", "{n}とのことですが。", "{b}、とのご質問です。", "{b}という質問をいただきました。", "以下の質問を受け取りました: {q}", "次の質問に答えます。{q}", "質問を確認します。{q}", "質問文: {q}\n回答文: {q}", "You asked: {q}", "You are asking: {q}", "The question is: {q}", "The question asks {b}.", "Your question was \"{q}\"", "So you want to know: {b}", "I understand that you want to know: {b}", "Regarding your question: {q}", "{q} That is the question.", "您的问题是:{q}", "问题:{q}", "你问的是:{q}", "질문: {q}", "{b}。", "{b}？", "{b}！", "{b}."]
#: Forms in which a question asks, one put for the other when it is reworded.
FORMS_TELL = ["を説明してください", "を教えてください", "を述べてください", "を示してください", "を述べなさい", "を説明せよ", "を述べよ", "を教えて", "は何ですか", "について説明してください", "について教えてください", "をお教えください", "を知りたい", "とは何か", "はどのようなものですか", "を答えよ", "を挙げよ", "を挙げてください", "はどうですか", ""]
FORMS_ASK = ["ですか", "ますか", "でしょうか", "か", "のですか", "のでしょうか", "のか", "だろうか", "ますでしょうか", "かどうか教えてください", "か答えてください", "か知りたい"]

# A few sentences of many languages, from which character profiles are counted.
LANGUAGES = {
    "en": ["The pressure rises slowly after the valve opens.", "We compared both methods under the same load.", "It was found that the surface wears evenly.", "No change was seen after ten hours of use.", "This is because the bearing should not be heated before it is mounted.", "When the motor stops, the temperature of the oil falls and the flow becomes weak.", "Which part has to be replaced first, and how often should it be checked?", "Why does the pump lose power above this speed?", "What limits the life of the seal in this test?", "How can the stiffness of the shaft be measured?", "Figure 3 shows that the results agree with the calculation within five percent.", "The part was reduced by replacing the old spring with a shorter one."],
    "de": ["Der Druck steigt nach dem Öffnen langsam an.", "Wir haben beide Verfahren bei gleicher Last verglichen.", "Die Oberfläche nutzt sich gleichmäßig ab.", "Nach zehn Stunden war keine Änderung zu sehen.", "Das liegt daran, dass das Lager vor dem Einbau nicht erwärmt werden sollte.", "Wenn der Motor steht, sinkt die Temperatur des Öls und die Strömung wird schwächer.", "Welches Teil muss zuerst ersetzt werden?"],
    "fr": ["La pression monte lentement après l'ouverture de la vanne.", "Nous avons comparé les deux méthodes sous la même charge.", "La surface s'use de façon régulière.", "Aucun changement n'a été observé après dix heures.", "C'est parce que le palier ne doit pas être chauffé avant le montage.", "Quand le moteur s'arrête, la température de l'huile baisse et le débit devient faible."],
    "es": ["La presión sube despacio después de abrir la válvula.", "Comparamos los dos métodos con la misma carga.", "La superficie se desgasta de manera uniforme.", "No se observó ningún cambio después de diez horas.", "Esto se debe a que el cojinete no debe calentarse antes del montaje.", "Cuando el motor se detiene, la temperatura del aceite baja y el flujo es más débil."],
    "it": ["La pressione sale lentamente dopo l'apertura della valvola.", "Abbiamo confrontato i due metodi con lo stesso carico.", "La superficie si consuma in modo uniforme.", "Dopo dieci ore non è stato osservato alcun cambiamento.", "Quando il motore si ferma, la temperatura dell'olio scende e il flusso diventa debole."],
    "pt": ["A pressão sobe devagar depois de abrir a válvula.", "Comparamos os dois métodos com a mesma carga.", "A superfície se desgasta de maneira uniforme.", "Não foi observada nenhuma mudança após dez horas.", "Quando o motor para, a temperatura do óleo cai e o fluxo fica mais fraco."],
    "nl": ["De druk stijgt langzaam nadat de klep is geopend.", "We hebben beide methoden bij dezelfde belasting vergeleken.", "Het oppervlak slijt gelijkmatig.", "Na tien uur was er geen verandering te zien.", "Als de motor stopt, daalt de temperatuur van de olie."],
    "sv": ["Trycket stiger långsamt efter att ventilen har öppnats.", "Vi jämförde båda metoderna vid samma belastning.", "Ytan slits jämnt.", "Efter tio timmar syntes ingen förändring.", "När motorn stannar sjunker oljans temperatur."],
    "da": ["Trykket stiger langsomt, efter at ventilen er åbnet.", "Vi sammenlignede begge metoder ved samme belastning.", "Overfladen slides jævnt.", "Efter ti timer var der ingen ændring at se.", "Når motoren standser, falder oliens temperatur."],
    "fi": ["Paine nousee hitaasti venttiilin avaamisen jälkeen.", "Vertasimme molempia menetelmiä samalla kuormalla.", "Pinta kuluu tasaisesti.", "Kymmenen tunnin jälkeen ei havaittu muutosta.", "Kun moottori pysähtyy, öljyn lämpötila laskee."],
    "pl": ["Po otwarciu zaworu ciśnienie powoli rośnie.", "Porównaliśmy obie metody przy tym samym obciążeniu.", "Powierzchnia zużywa się równomiernie.", "Po dziesięciu godzinach nie zauważono żadnej zmiany.", "Gdy silnik się zatrzymuje, temperatura oleju spada."],
    "cs": ["Po otevření ventilu tlak pomalu stoupá.", "Porovnali jsme obě metody při stejném zatížení.", "Povrch se opotřebovává rovnoměrně.", "Po deseti hodinách nebyla vidět žádná změna.", "Když se motor zastaví, teplota oleje klesá."],
    "hu": ["A szelep kinyitása után a nyomás lassan emelkedik.", "Mindkét módszert azonos terhelés mellett hasonlítottuk össze.", "A felület egyenletesen kopik.", "Tíz óra után nem látszott változás."],
    "ro": ["Presiunea crește încet după deschiderea supapei.", "Am comparat cele două metode la aceeași sarcină.", "Suprafața se uzează uniform.", "După zece ore nu s-a observat nicio schimbare."],
    "tr": ["Vana açıldıktan sonra basınç yavaşça yükselir.", "Her iki yöntemi aynı yük altında karşılaştırdık.", "Yüzey eşit şekilde aşınır.", "On saat sonra hiçbir değişiklik görülmedi."],
    "vi": ["Áp suất tăng chậm sau khi mở van.", "Chúng tôi đã so sánh hai phương pháp dưới cùng một tải trọng.", "Bề mặt mòn đều.", "Sau mười giờ sử dụng không thấy thay đổi nào."],
    "id": ["Tekanan naik perlahan setelah katup dibuka.", "Kami membandingkan kedua metode dengan beban yang sama.", "Permukaan aus secara merata.", "Tidak ada perubahan setelah sepuluh jam."],
    "zh": ["阀门打开之后,压力会慢慢上升。", "我们在相同的载荷下比较了两种方法。", "结果表明,表面的磨损是均匀的。", "使用十小时之后没有发现变化。"],
    "ko": ["밸브를 열면 압력이 천천히 올라간다.", "같은 하중에서 두 방법을 비교하였다.", "표면은 고르게 마모되는 것으로 나타났다.", "열 시간 후에도 변화가 없었다."],
    "ru": ["Давление медленно растёт после открытия клапана.", "Мы сравнили оба метода при одинаковой нагрузке.", "Поверхность изнашивается равномерно."],
    "ar": ["يرتفع الضغط ببطء بعد فتح الصمام.", "قارنا الطريقتين تحت الحمل نفسه."], "th": ["ความดันเพิ่มขึ้นอย่างช้าๆ หลังจากเปิดวาล์ว", "เราเปรียบเทียบทั้งสองวิธีภายใต้ภาระเดียวกัน"], "he": ["הלחץ עולה לאט לאחר פתיחת השסתום.", "השווינו את שתי השיטות תחת אותו עומס."], "hi": ["वाल्व खुलने के बाद दबाव धीरे-धीरे बढ़ता है।", "हमने समान भार पर दोनों विधियों की तुलना की।"], "el": ["Η πίεση ανεβαίνει αργά μετά το άνοιγμα της βαλβίδας.", "Συγκρίναμε και τις δύο μεθόδους με το ίδιο φορτίο."],
    "ja": ["弁を開くと圧力がゆっくり上がる。", "同じ荷重で二つの方法を比べた。", "表面は均一にすり減ることがわかった。", "十時間の使用後も変化は見られなかった。"],
}
#: How a question asks for one of them.
ASKS = {"en": ("英語", "English"), "zh": ("中国語", "Chinese"), "ja": ("日本語", "Japanese"), "de": ("ドイツ語", "German"), "fr": ("フランス語", "French"), "ko": ("韓国語", "Korean"), "es": ("スペイン語", "Spanish"), "ru": ("ロシア語", "Russian"), "it": ("イタリア語", "Italian"), "pt": ("ポルトガル語", "Portuguese"), "th": ("タイ語", "Thai"), "vi": ("ベトナム語", "Vietnamese")}

# Short answers that are sound, and openings that hedge without refusing.
SHORT = ["はい", "はい。", "いいえ", "いいえ。", "ある", "ない", "ない。", "できる", "できない", "できません。", "可能です", "不可能です。", "生じない。", "生じます。", "増加する", "減少する。", "上昇", "低下", "変化なし", "異常なし", "問題なし", "影響なし", "異状なし", "損傷なし", "左側", "右側", "上部", "下部", "三回", "二回", "同じ", "等しい", "大きい", "小さい", "高い。", "比例する", "約半分", "Yes", "Yes.", "No", "No.", "It does.", "It does not.", "True", "False", "Both.", "Neither.", "never", "twice", "是", "否", "是的。", "不会。", "네.", "아니요.", "正しい", "誤り", "最大", "最小", "中央", "毎日", "年に一回", "開放", "閉", "開", "合格", "不合格", "良好", "正常", "不良"]
HEDGES = ["一概には言えませんが、", "正確な値はわかりませんが、", "詳しくは不明ですが、", "残念ながら完全には防げませんが、", "申し訳ありませんが少し長くなります。", "断定はできませんが、", "記録は残っていませんが、", "確かなことは言えませんが、", "I'm not certain, but ", "It is hard to say exactly, but ", "恐縮ですが手短にお答えします。", "お答えします。", "ご質問ありがとうございます。", "一般には公開されていませんが、"]
#: What a part can't do, said of things: sentences that look like refusals and are none.
CANT = ["{t}は{v}できません。", "{t}を{v}することはできません。", "{t}は{v}できないため、{u}を使います。", "{t}がないと{v}できません。", "{t}では{v}が認められていません。", "{t}の{v}は禁止されています。", "{t}への立入りは控えます。", "{t}は{v}の対象外です。", "{t}の{v}は見られません。", "{t}は{v}しません。", "{t}の原因はまだわかっていません。", "{t}には{v}の記録がありません。", "{t}を外さずに{u}を{v}することはできません。そのため{u}から推定します。", "{t}は外から見て判断できません。{u}を調べれば{v}できます。", "{t}の不具合は見られません。", "{t}に{u}はありません。", "{t}は{u}に影響しません。", "{t}は{v}が難しいので、{u}に替えます。", "{t}が止まると{u}は{v}できなくなります。", "No {t} was found.", "The {t} is not affected by this.", "Without the {t} it will not start.", "The {t} cannot be replaced while it runs.", "The {t} does not stop.", "It is not possible to {w} the {t}."]
BRIEF = ["{t}です。", "{t}と{u}。", "{t}が最も大きく影響します。", "{t}が原因と考えられます。", "{t}を{v}します。", "{t}より{u}が先です。", "{t}の{v}が必要です。", "主に{t}による。", "{t}に依存する。", "{t}では変わりません。", "{t}から推定します。", "{t}の劣化", "{t}の{v}不足", "{t}と{u}の差", "{t}だけで十分です。", "{t}にはあまり関係しません。", "{t}が大きいほど{u}は小さくなる", "{t}を{v}してから{u}を外します。", "It is the {t}.", "{t} and {u}", "Mainly because of the {t}.", "The {t} depends on the {u}.", "By checking the {t} first."]
CANT_VERBS = ["測定", "検出", "交換", "使用", "運転", "補償", "防止", "停止", "調整", "再現", "計算", "接続", "固定", "加工", "再利用", "確保", "冷却"]


def part_of(items: Sequence[str], held: bool | None) -> list[str]:
    """Three quarters of the items to learn from, the other quarter to be judged on (``held``), or all of them (None); nothing at all is in both."""
    if held is None:
        return list(items)
    own = [x for x in items if not x or (crc32(x.encode()) % 4 == 0) == held]
    return own or list(items)


def hollow(rng: random.Random, held: bool | None = None) -> str:
    """An answer without content."""
    kind = rng.random()
    if kind < 0.4:
        return rng.choice(part_of(HOLLOW, held))
    if kind < 0.7:
        x = rng.choice(part_of(NOTHING, held))
    elif kind < 0.8:
        x = rng.choice(_NO) + rng.choice(part_of(_OF, held)) + rng.choice(_AFTER)
    elif kind < 0.92:
        x = rng.choice(part_of(_WHAT, held)) + rng.choice(part_of(_LACKS, held))
    else:
        x = rng.choice(part_of(_DOING, held)) + rng.choice(part_of(_YET, held))
    x = rng.choice([x, x, x, x.upper(), x.capitalize()])
    return rng.choice(["{}", "{}", "{}", "({})", "（{}）", "[{}]", "【{}】", "<{}>", "「{}」", "回答: {}", "A: {}", "{}。", "{}.", "-- {} --", "*{}*", "※{}", '{{"answer": "{}"}}', "<p>{}</p>", "{}\n"]).format(x)


def refusal(rng: random.Random, topic: str, held: bool | None = None, english: str = "") -> str:
    """A refusal in one of several languages about ``topic`` (``english`` in English) or nothing in particular."""
    kind = rng.random()
    if kind < 0.24:
        topic = english or topic
        core = rng.choice(part_of(EN_CORE, held)).replace("{t}", rng.choice([topic, "this topic", "that", "the " + topic]) if topic else "this topic")
        frame = rng.choice(part_of(EN_FRAME, held))
        return (frame + core if frame else core[0].upper() + core[1:]) + rng.choice(part_of(EN_TAIL, held))
    if kind < 0.4:
        return rng.choice(part_of(OTHER_REFUSALS, held)).replace("{t}", topic)
    about = rng.choice(part_of(JA_ABOUT, held)).replace("{t}", topic or "それ")
    if rng.random() < 0.5:
        core = rng.choice(part_of(JA_VERB, held)) + rng.choice(part_of(JA_UNABLE, held))
    else:
        core = rng.choice(part_of(JA_WHOLE, held))
    return rng.choice(part_of(JA_FRAME, held)) + about + core.rstrip("。") + rng.choice(["。", "。", "。", ""]) + rng.choice(part_of(JA_TAIL, held))
